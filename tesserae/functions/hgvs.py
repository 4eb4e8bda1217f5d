"""HGVS notation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_variant(position: Column, ref: Column, new: Column) -> Column:
    """Notation of one variant within its sequence."""
    pos, n, m = position.cast("long"), F.length(ref), F.length(new)
    span = F.concat(pos.cast("string"), F.lit("_"), (pos + n - 1).cast("string"))
    one = pos.cast("string")
    return (
        F.when((ref == new) & (n <= 1), F.concat(one, F.lit("=")))
        .when(ref == new, F.concat(span, F.lit("=")))
        .when((m == 0) & (n == 1), F.concat(one, F.lit("del")))
        .when(m == 0, F.concat(span, F.lit("del")))
        .when((n == 1) & (m == 1), F.concat(one, ref, F.lit(">"), new))
        .when(n == 0, F.concat((pos - 1).cast("string"), F.lit("_"), one, F.lit("ins"), new))
        .when(n == 1, F.concat(one, F.lit("delins"), new))
        .otherwise(F.concat(span, F.lit("delins"), new))
    )


def genomic(seqname: Column, position: Column, ref: Column, new: Column) -> Column:
    return F.concat(seqname, F.lit(":g."), format_variant(position, ref, new))


def pad_left(position: Column, ref: Column, new: Column, left: Column) -> tuple[Column, Column, Column]:
    """(position, ref, new) with the base before, if ref or new is empty."""
    bare = (F.length(ref) == 0) | (F.length(new) == 0)
    return (
        F.when(bare, position - F.length(left)).otherwise(position).cast("long"),
        F.when(bare, F.concat(left, ref)).otherwise(ref),
        F.when(bare, F.concat(left, new)).otherwise(new),
    )


def order_key(position: Column, ref: Column, new: Column, exports: bool = False) -> list[Column]:
    """Exports order by position, new, ref; matrices by position, ref, new."""
    return [position, new, ref] if exports else [position, ref, new]


def genotype_cell(seqname: Column, a: Column, b: Column) -> Column:
    """Cell of two alleles, structs of position, ref and new: N without coverage (new is -), . for the reference."""

    def text(v):
        return format_variant(v["position"], v["ref"], v["new"])

    same = (a["position"] == b["position"]) & (a["ref"] == b["ref"]) & (a["new"] == b["new"])
    none = (a["new"] == "-") | (b["new"] == "-")
    return (
        F.when(none, F.lit("N"))
        .when(same & (a["ref"] == a["new"]), F.lit("."))
        .when(same, F.concat(seqname, F.lit(":g."), text(a)))
        .otherwise(F.concat(seqname, F.lit(":g.["), text(a), F.lit("];["), text(b), F.lit("]")))
    )


def genotype(ref: Column, alts: Column, a: Column, b: Column) -> Column:
    """a/b, places of two alleles (structs of ref and new) among ``alts`` from 1; 0 for another ref or no such alt."""

    def place(v):
        return F.when(v["ref"] == ref, F.coalesce(F.array_position(alts, v["new"]), F.lit(0))).otherwise(0).cast("string")

    return F.concat(place(a), F.lit("/"), place(b))
