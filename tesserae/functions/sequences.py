"""Functions of names and sequences."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def trim_label(path: Column) -> Column:
    """Label of a file: its base name without .gz .fa .fasta .1 .2 .gz .vcf, taken off in that order; commas become dashes."""
    out = F.regexp_replace(path, "^.*/", "")
    for suffix in (".gz", ".fa", ".fasta", ".1", ".2", ".gz", ".vcf"):
        out = F.when(out.endswith(suffix), F.regexp_replace(out, suffix.replace(".", r"\.") + "$", "")).otherwise(out)
    return F.translate(out, ",", "-")


def strip_chr(name: Column) -> Column:
    return F.regexp_replace(name, "^chr", "")


def is_known(seq: Column) -> Column:
    """Whether all bases are a, c, g or t, in either case."""
    return ~seq.rlike("[^acgtACGT]")


def count_bases(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[^acgtACGT]", ""))


def two_bit(kmer: Column, k: int) -> Column:
    """Number of a k-mer of up to 31 bases: a 0, c 1, g 2, t 3, the first base highest; null with other bases."""
    digits = F.translate(F.lower(kmer), "acgt", "0123")
    return F.when((F.length(kmer) == k) & is_known(kmer), F.conv(digits, 4, 10).cast("long"))


def from_two_bit(number: Column, k: int) -> Column:
    return F.translate(F.lpad(F.conv(number.cast("string"), 10, 4), k, "0"), "0123", "acgt")


@F.pandas_udf(T.StringType())
def blake2b_hex(seq: pd.Series) -> pd.Series:
    """Hex BLAKE2b-256 of the sequence in lower case; ``sha2`` is the native choice where parity doesn't matter."""
    return seq.map(lambda s: None if s is None else hashlib.blake2b(s.lower().encode(), digest_size=32).hexdigest())


def tile_hash(seq: Column) -> Column:
    return F.sha2(F.lower(seq), 256)


def hash_prefix(hash_hex: Column, digits: int = 13) -> Column:
    return F.substring(hash_hex, 1, digits)


def library_name(version: Column, genome: Column) -> Column:
    return F.concat(version, genome, F.lit("_library"))


def chromosome_order(name: Column) -> list[Column]:
    """Natural order: numbers by value, then names."""
    bare = strip_chr(name)
    return [F.coalesce(bare.try_cast("int"), F.lit(1 << 30)), bare]
