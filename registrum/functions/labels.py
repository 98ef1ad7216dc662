"""Labels and bands of the documented layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes and labels of the layout.
COMPANY_SIZE = {1: "NÃO INFORMADO", 2: "MICRO EMPRESA", 3: "EMPRESA DE PEQUENO PORTE", 5: "DEMAIS"}
OFFICE_KIND = {1: "MATRIZ", 2: "FILIAL"}
STATUS = {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}
PARTNER_KIND = {1: "PESSOA JURÍDICA", 2: "PESSOA FÍSICA", 3: "ESTRANGEIRO"}
REGIME_FLAG = {"S": "SIM", "N": "NÃO", "": "OUTROS"}

# The oldest age of bands 1 to 8; band 9 is open, band 0 is "not applicable".
BAND_TOPS = (12, 20, 30, 40, 50, 60, 70, 80)


def label(c: Column, labels: dict) -> Column:
    """The label of a code, null for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.try_element_at(table, c)


def regime_label(c: Column) -> Column:
    """S / N / blank, where a missing flag counts as blank."""
    return label(F.coalesce(F.trim(c), F.lit("")), REGIME_FLAG)


def age_band(age: Column) -> Column:
    band = F.when(age.isNull() | (age < 0), 0)
    for number, top in enumerate(BAND_TOPS, start=1):
        band = band.when(age <= top, number)
    return band.otherwise(len(BAND_TOPS) + 1)
