import random

from registrum.llm import preference
from registrum.llm.queries import op1_common_prefix_preference

SCHEMA = "conv_id long, turn long, role string, text string, part string, rendered int"


def brute(chosen, rejected):
    out = {}
    for pair in {r[0] for r in chosen + rejected} - {None}:
        def side(rows):
            return {(preference.LAST if r[1] is None else r[1], r[2] or "", r[3] or "") for r in rows if r[0] == pair}

        a, b = side(chosen), side(rejected)
        end = min((t[0] for t in a ^ b), default=None)

        def text(rows, part):
            picked = sorted(t for t in rows if (end is None or t[0] < end) == (part == "prompt"))
            bodies = [f"<|{r}|>\n{t}<|end|>\n" for _, r, t in picked]
            return "".join(bodies), [x for x, (_, r, _) in zip(bodies, picked) if r == "assistant"]

        out[pair] = (text(a & b, "prompt")[0], text(a, "chosen"), text(b, "rejected"))
    return out


def test_matches_brute_force(spark):
    rng = random.Random(9)
    chosen, rejected = [], []
    for pair in range(40):
        length, split = rng.randint(0, 8), rng.randint(0, 8)
        for t in range(length):
            role = ["user", "assistant"][t % 2]
            chosen.append((pair, t, role, f"text {t} é"))
            rejected.append((pair, t, role, f"text {t} é" if t < split else f"other {t}"))
        if pair % 5 == 0:
            rejected.append((pair, length, "assistant", "one more"))
    chosen += [(None, 0, "user", "lost"), (50, None, None, None), (51, 0, "user", ""), chosen[0], chosen[0]]
    chosen += [(52, i, "assistant", "long " * 2000) for i in range(300)]
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)

    found = preference.segments(make(chosen), make(rejected))
    rows = preference.assembled(found).collect()
    wanted = brute(chosen, rejected)
    assert {r.pair for r in rows} == wanted.keys()
    for r in rows:
        prompt, (c, c_trained), (j, j_trained) = wanted[r.pair]
        assert (r.prompt, r.chosen, r.rejected) == (prompt, c, j)
        assert [r.chosen[s.start : s.stop] for s in r.chosen_trained] == c_trained
        assert [r.rejected[s.start : s.stop] for s in r.rejected_trained] == j_trained


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert preference.segments(none, none).count() == 0


def test_query_keeps_every_conversation_and_turn(spark, tmp_path):
    rows = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (0, 3, "assistant", "d"), (0, 4, "user", "e"),
        (1, 0, "user", "f"), (1, 1, "assistant", "g"), (1, 2, "user", "h"), (1, 3, "assistant", "i"),
        (2, 0, "user", "j"), (2, 1, "user", "k"),  # no answer
        (3, 0, "assistant", None), (3, 0, "assistant", None),  # a neighbour without one, a repeated row
        (5, None, "assistant", "l"), (None, 0, "user", "m"), (4, None, None, None),
    ]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    found = {r.conv_id: r for r in op1_common_prefix_preference(spark, str(tmp_path)).collect()}
    kept = {(*r[:1], preference.LAST if r[1] is None else r[1], *r[2:]) for r in rows if r[0] is not None}
    final = {0: "d", 1: "i", 3: "", 5: "l"}
    replaced = {0: 1, 1: 3, 2: 1, 3: 0, 4: preference.LAST, 5: preference.LAST}
    assert found.keys() == replaced.keys()
    for pair, r in found.items():
        chosen = [(t, role or "", text or "") for c, t, role, text in kept if c == pair]
        rejected = [x for x in chosen if x[0] != replaced[pair]]
        if pair in final and pair ^ 1 in final:
            rejected.append((replaced[pair], "assistant", final[pair ^ 1]))
        end = min((x[0] for x in set(chosen) ^ set(rejected)), default=None)

        def chars(side, prompt, trained=False):
            picked = [x for x in side if (end is None or x[0] < end) == prompt]
            return sum(
                len(f"<|{x[1]}|>\n{x[2]}<|end|>\n") for x in picked if not trained or x[1] == "assistant"
            )

        assert (r.prompt_chars, r.chosen_chars, r.rejected_chars) == (
            chars(chosen, True), chars(chosen, False), chars(rejected, False)
        )
        assert (r.chosen_trained_chars, r.rejected_trained_chars) == (
            chars(chosen, False, True), chars(rejected, False, True)
        )
    # The fifth turn comes after the last answer and stays in both completions.
    assert found[0].prompt_turns == 1 and found[1].prompt_turns == 3
