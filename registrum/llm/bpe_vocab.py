"""A public BPE vocabulary file as the tasks need it, loaded once per Python worker."""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct

import numpy as np

from registrum.llm.chunk_memo import ChunkMemo

# Longer fragments are rare; remembering them would fill a worker's memory.
REMEMBER_CHARS = 48
REMEMBER_ENTRIES = 150_000
REMEMBER_WORDS = 250_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Vocabulary, merge ranks and the byte pairs that occur inside some token."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout"):
            raise ValueError("a plain byte-level BPE vocabulary is needed")
        pretokenizer = json.dumps(data.get("pre_tokenizer"))
        if "ByteLevel" not in pretokenizer or '"add_prefix_space": true' in pretokenizer:
            raise ValueError("a byte-level vocabulary without a prefix space is needed")
        if data.get("decoder") is not None or data.get("post_processor") is not None:
            raise ValueError("a vocabulary without decoder and post-processor is needed")
        tokenizer = Tokenizer.from_file(path)
        self.normalize = tokenizer.normalizer.normalize_str
        self.pre_tokenize = tokenizer.pre_tokenizer.pre_tokenize_str
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(merges)}
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        for token in data["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError("added tokens must be plain strings")
        by_length = sorted(self.added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.added.items()}
        self.inside = set()
        for token in self.ids:
            body = token.removesuffix(self.end) if self.end else token
            self.inside.update(zip(body, body[1:]))
        symbols = byte_symbols()
        self._symbols = {b: symbols[b] for b in range(256)}
        self._fragments: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        # Whether simple text may hold an added token.
        self._simple_added = any(all(map(self._simple.fullmatch, t)) for t in self.added)
        self.memo = ChunkMemo(lambda chunks: [self.chunk_ids(c) for c in chunks])

    # Letters whose normal form, case and class have not changed in any Unicode version.
    _simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([.,;:!?|%#$&*]*)")

    def words(self, text: str) -> list[str]:
        """The words of normalised text, one character per byte."""
        simple = self._simple.fullmatch(text)
        if simple:
            parts = [p for p in (simple[1].lower(), simple[2]) if p]
            return [p if p.isascii() else self.as_symbols(p) for p in parts]
        return [word for word, _ in self.pre_tokenize(self.normalize(text))]

    def token_table(self) -> np.ndarray:
        """Tokens by id; an id without a token has none and cannot be joined."""
        table = np.full(max(self.tokens) + 1, None, object)
        for i, token in self.tokens.items():
            table[i] = token
        return table

    def as_symbols(self, text: str) -> str:
        return text.encode("utf-8").decode("latin-1").translate(self._symbols)

    def forced_fragments(self, word: str) -> list[str]:
        """Cuts a word between bytes that stand side by side in no token.

        A merge across such a place would build a token that holds the pair, so the
        fragments are encoded as they would be within the word.
        """
        inside = self.inside
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in inside]
        if not cuts:
            return [word]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def fragment_ids(self, fragment: str, last: bool) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        key = fragment + self.end if last else fragment
        found = self._fragments.get(key)
        if found is None:
            whole = self.ids.get(key)
            if whole is not None and len(fragment) == 1:
                return whole.to_bytes(4, "little")
            symbols = list(fragment)
            if last:
                symbols[-1] += self.end
            ids = [self.ids[s] for s in self.merge(symbols)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(fragment) <= REMEMBER_CHARS:
                if len(self._fragments) >= REMEMBER_ENTRIES:
                    self._fragments = {}
                self._fragments[key] = found
        return found

    def merge(self, symbols: list[str]) -> list[str]:
        """Applies merges, lowest rank first and leftmost among equals."""
        ranks = self.ranks
        if len(symbols) <= 24:
            get, none = ranks.get, len(ranks)
            order = [get(p, none) for p in zip(symbols, symbols[1:])]
            while order:
                best = min(order)
                if best == none:
                    break
                i = order.index(best)
                symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
                del order[i]
                if i < len(order):
                    order[i] = get((symbols[i], symbols[i + 1]), none)
                if i:
                    order[i - 1] = get((symbols[i - 1], symbols[i]), none)
            return symbols
        # Long fragments: a heap of pairs over a linked list.
        after = [*range(1, len(symbols)), -1]
        before = [-1, *range(len(symbols) - 1)]
        heap = [(ranks[p], i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if j < 0 or (symbols[i], symbols[j]) != pair:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (symbols[a], symbols[b]) in ranks:
                    heapq.heappush(heap, (ranks[symbols[a], symbols[b]], a, (symbols[a], symbols[b])))
        return [s for s in symbols if s]

    def word_ids(self, word: str) -> bytes:
        """Ids of a word, remembered in two generations: what is met again moves on."""
        found = self._words.get(word)
        if found is None:
            found = self._older.get(word)
            if found is None:
                *first, last = self.forced_fragments(word)
                ids = [self.fragment_ids(fragment, False) for fragment in first]
                found = b"".join([*ids, self.fragment_ids(last, True)])
            if len(word) <= REMEMBER_CHARS:
                if len(self._words) >= REMEMBER_WORDS:
                    self._words, self._older = {}, self._words
                self._words[word] = found
        return found

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a text without blanks or line feeds."""
        if not self._simple_added and self._simple.fullmatch(chunk):
            return b"".join(map(self.word_ids, self.words(chunk)))
        ids = []
        parts = self.added_split.split(chunk) if self.added_split else [chunk]
        for part in parts:
            if part in self.added:
                ids.append(self.added[part].to_bytes(4, "little"))
            elif part:
                ids.extend(map(self.word_ids, self.words(part)))
        return b"".join(ids)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
