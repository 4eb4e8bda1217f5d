"""Readers of sequences, regions, samples and variant lines, all through Spark's sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserae import schema
from tesserae.functions.sequences import trim_label

FASTA_NAMES = r"\.(fa|fasta)(\.gz)?$"


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, seqname, seq) of every contig: the label is all of the header line, bases are lower case.

    A record is the text between line starts with ``>``, so contigs, not files, are the rows.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select("value", F.input_file_name().alias("file"))
    text = F.regexp_replace("value", "^>|\r", "")
    split = F.split(text, "\n", 2)
    named = records.where(F.trim("value") != "").select("file", split[0].alias("seqname"), F.coalesce(F.get(split, 1), F.lit("")).alias("body"))
    return named.select("file", "seqname", F.lower(F.translate("body", "\n", "")).alias("seq"))


def check_fasta(contigs: DataFrame) -> DataFrame:
    """The contigs, or an error that names the first with > or a space among its bases."""
    bad = F.col("seq").rlike("[> ]")
    message = F.concat(F.lit("unexpected character in "), "seqname", F.lit(" at "), F.regexp_instr("seq", F.lit("[> ]")).cast("string"))
    return contigs.withColumn("seq", F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("seq")))


def read_tags(spark: SparkSession, path: str) -> DataFrame:
    """(tag, tagseq): lines without > are tags, numbered in order of the file, which is read whole."""
    whole = spark.read.text(path, wholetext=True)
    lines = F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: (F.length(x) > 0) & ~x.startswith(">"))
    return whole.select(F.posexplode(F.transform(lines, F.lower)).alias("tag", "tagseq"))


def check_tags(tags: DataFrame, key_length: int = 32) -> DataFrame:
    """Tags whose first bases, as many as the shortest has, are not theirs alone; empty for a sound tag set."""
    k = tags.agg(F.least(F.min(F.length("tagseq")), F.lit(key_length))).first()[0] or 0
    return tags.groupBy(F.substring("tagseq", 1, k).alias("key")).agg(F.count("*").alias("n"), F.array_sort(F.collect_list("tag")).alias("tags")).where("n > 1")


def read_regions(spark: SparkSession, path: str, expand: int = 0) -> DataFrame:
    return parse_regions(spark.read.text(path), expand)


def parse_regions(lines: DataFrame, expand: int = 0) -> DataFrame:
    """(seqname, start, end) of BED lines (fields 2, 3) or GFF lines (fields 4, 5, end one more), widened by ``expand``."""
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(f.alias("f")).where(F.size("f") >= 3)
    a, b = F.get("f", 1).try_cast("long"), F.get("f", 2).try_cast("long")
    c, d = F.get("f", 3).try_cast("long"), F.get("f", 4).try_cast("long") + 1
    bed = a.isNotNull() & b.isNotNull()
    start, end = F.when(bed, a).otherwise(c), F.when(bed, b).otherwise(d)
    out = rows.select(F.regexp_replace(F.get("f", 0), "^chr", "").alias("seqname"), (start - expand).alias("start"), (end + expand).alias("end"))
    return out.where(F.col("start").isNotNull() & F.col("end").isNotNull())


def list_inputs(spark: SparkSession, directory: str) -> DataFrame:
    """(path, kind) of the inputs below ``directory``: haplotype pairs by their first file, references, indexed VCFs.

    A file that is none of these is an error when its row is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory).select("path")
    index = files.select(F.regexp_replace("path", r"\.(tbi|csi)$", "").alias("path")).join(files, "path", "left_semi").distinct().withColumn("indexed", F.lit(True))
    rows = files.where(~F.col("path").rlike(r"\.(tbi|csi)$|\.2\.(fa|fasta)(\.gz)?$")).join(index, "path", "left")
    kind = (
        F.when(F.col("path").rlike(r"\.1\.(fa|fasta)(\.gz)?$"), "pair")
        .when(F.col("path").rlike(FASTA_NAMES), "reference")
        .when(F.col("path").rlike(r"\.vcf(\.gz)?$") & F.col("indexed"), "vcf")
        .when(F.col("path").rlike(r"\.vcf(\.gz)?$"), F.raise_error(F.concat(F.lit("no index for "), "path")).cast("string"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown kind of file: "), "path")).cast("string"))
    )
    return rows.select("path", kind.alias("kind"))


def haplotypes(contigs: DataFrame) -> DataFrame:
    """Contigs of X.1.fa and X.2.fa with the sample X and phase 0 or 1; other files get phase null."""
    base = F.regexp_replace("file", "^.*/", "")
    phase = F.regexp_extract(base, r"\.([12])\.(fa|fasta)(\.gz)?$", 1)
    sample = F.regexp_replace(base, r"(\.[12])?\.(fa|fasta)(\.gz)?$", "")
    return contigs.withColumn("sample", sample).withColumn("phase", F.when(phase != "", phase.cast("int") - 1))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """samples.csv: Index, SampleID, CaseControl, TrainingValidation and any number of PCA columns."""
    raw = spark.read.csv(path, header=True)
    components = [F.col(f"`{c}`").cast("double") for c in raw.columns[4:]]
    idx, sample, status, split = raw.columns[:4]
    return raw.select(F.col(idx).cast("int").alias("idx"), F.col(sample).alias("sample_id"), F.col(status).try_cast("int").alias("case_control"), F.col(split).try_cast("int").alias("training"), F.array(*components).cast("array<double>").alias("pca"))


def check_samples(samples: DataFrame) -> DataFrame:
    """Rows that break the numbering 0, 1, 2...: an index that comes twice, or isn't below the number of rows."""
    n = samples.count()
    twice = samples.groupBy("idx").count().where("count > 1").select("idx")
    return samples.where((F.col("idx") < 0) | (F.col("idx") >= n) | F.col("idx").isNull()).select("idx").unionByName(twice).distinct()


def read_case_control(spark: SparkSession, path: str, column: str) -> DataFrame:
    """(pattern, status) of case/control TSVs: the first column, and the one named ``column`` in the header."""
    raw = spark.read.csv(path, header=True, sep="\t")
    return raw.select(F.col(f"`{raw.columns[0]}`").alias("pattern"), F.col(f"`{column}`").alias("status"))


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("pattern")).where("pattern <> ''")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Annotation CSV of 8 fields, or 9 with the base on the left."""
    return spark.read.schema(schema.ANNOTATIONS).csv(path).na.fill("", ["ref", "new", "left"])


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf(spark.read.text(path))


def read_vcfs(spark: SparkSession, path: str) -> DataFrame:
    """Records of many (g)VCF files, each of one sample, which its file names (``sample_id``)."""
    return parse_vcf(spark.read.text(path).withColumn("sample_id", trim_label(F.input_file_name())), "sample_id")


def parse_vcf(lines: DataFrame, *others: str) -> DataFrame:
    """Data lines of a (g)VCF with one sample as columns, the line itself beside them, and ``others`` of its columns."""
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(f.alias("f"), F.col("value").alias("line"), *others)
    names = ("chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "sample")
    cols = [F.get("f", k).alias(n) for k, n in enumerate(names)]
    out = rows.select("line", *cols, *others)
    return out.withColumn("pos", F.col("pos").cast("long")).withColumn("qual", F.col("qual").try_cast("double"))


def contig_sizes(header: DataFrame) -> DataFrame:
    """(label, length) of ##contig lines."""
    return header.where(F.col("value").startswith("##contig=")).select(F.regexp_extract("value", "ID=([^,>]+)", 1).alias("label"), F.regexp_extract("value", "length=([0-9]+)", 1).try_cast("long").alias("length"))


def genome_sizes(names: DataFrame, header_sizes: DataFrame, file_sizes: DataFrame) -> DataFrame:
    """Length of each name (label): from the VCF's header, else from the genome file."""
    a, b = header_sizes.withColumnRenamed("length", "_a"), file_sizes.withColumnRenamed("length", "_b")
    return names.join(a, "label", "left").join(b, "label", "left").withColumn("length", F.coalesce("_a", "_b")).drop("_a", "_b")


def read_library(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """A part of a library directory: tags, tile_variants, calls or ref_paths. Filters on chunk prune files."""
    return spark.read.parquet(f"{path}/{entity}")
