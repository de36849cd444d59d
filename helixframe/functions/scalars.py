"""Scalar expressions of the biological operators, all of them built-in functions underneath."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_num(value: Column) -> Column:
    """NaN and null become 0, infinities the largest doubles."""
    most = F.lit(1.7976931348623157e308)
    return F.greatest(-most, F.least(most, F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))))


def bin_round(value: Column, step: int) -> Column:
    """The nearest multiple of step, halves up."""
    return (F.floor((value + step // 2) / step) * step).cast("long")


def zero_padded(value: Column, width: int = 5) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def read_structure(seq: Column, structure: str) -> list[Column]:
    """Pieces of a read by a structure like 16C10M: one column for each length and letter, in order."""
    import re

    at, out = 1, []
    for size, letter in re.findall(r"(\d+)([A-Z])", structure):
        out.append(F.substring(seq, at, int(size)).alias(f"{letter}{len(out)}"))
        at += int(size)
    return out


def expand_ranges(text: Column) -> Column:
    """Residues of `A10-12/0 B5-5`: array of (chain, pos); `/0` breaks chains and names none."""
    parts = F.filter(F.split(F.replace(text, F.lit("/0"), F.lit("")), r"[\s,/]+"), lambda p: p.rlike(r"^[A-Z]\d+-\d+$"))

    def positions(p):
        chain = F.substring(p, 1, 1)
        ends = F.split(F.substring(p, 2, 100), "-")
        return F.transform(F.sequence(F.get(ends, 0).cast("int"), F.get(ends, 1).cast("int")), lambda i: F.struct(chain.alias("chain"), i.alias("pos")))

    return F.flatten(F.transform(parts, positions))


def mask_run(n: Column, token: str = "_") -> Column:
    return F.repeat(F.lit(token), n)


def split_chains(seq: Column) -> Column:
    """Chains of a complex written with `/` or `:` between them."""
    return F.split(seq, "[/:]")
