"""Readers of genomic text formats. Coordinates become 0-based half-open; bad lines are dropped, or counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BED = ["chrom", "start", "end", "name", "score", "strand"]
PEAKS = {"narrowPeak": [*BED, "signal", "pvalue", "qvalue", "peak"], "broadPeak": [*BED, "signal", "pvalue", "qvalue"], "bed6": BED}
_TYPES = {"start": "bigint", "end": "bigint", "score": "double", "signal": "double", "pvalue": "double", "qvalue": "double", "peak": "int", "thick_start": "bigint", "thick_end": "bigint", "length": "bigint"}


def _columns(lines: DataFrame, names: list[str], sep: str = "\t") -> DataFrame:
    parts = F.split("value", sep)
    cols = [F.expr(f"try_cast(_p[{i}] AS {_TYPES.get(n, 'string')})").alias(n) for i, n in enumerate(names)]
    plain = lines.filter(~F.col("value").rlike("^(#|track|browser|$)")).withColumn("_p", parts)
    return plain.filter(F.size("_p") >= len(names)).select(*cols)


def read_bed(spark: SparkSession, path: str, columns: list[str] = BED) -> DataFrame:
    """BED3, BED6 or BED6 with named further columns; rows without proper coordinates are dropped."""
    out = _columns(spark.read.text(path), columns)
    return out.filter("start IS NOT NULL AND `end` IS NOT NULL AND start <= `end` AND start >= 0")


def count_bad_lines(spark: SparkSession, path: str, columns: list[str] = BED) -> int:
    """Data lines that ``read_bed`` drops."""
    lines = spark.read.text(path).filter(~F.col("value").rlike("^(#|track|browser|$)"))
    return lines.count() - read_bed(spark, path, columns).count()


def read_bed12(spark: SparkSession, path: str) -> DataFrame:
    """BED12 with ``blocks``; rows whose block lists differ in length are dropped."""
    names = [*BED, "thick_start", "thick_end", "rgb", "block_count", "block_sizes", "block_starts"]
    out = read_bed(spark, path, names)
    longs = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long"))
    out = out.withColumns({"_s": longs("block_sizes"), "_b": longs("block_starts")}).filter(F.size("_s") == F.size("_b"))
    blocks = F.zip_with("_b", "_s", lambda b, s: F.struct((F.col("start") + b).alias("start"), (F.col("start") + b + s).alias("end")))
    return out.withColumn("blocks", blocks).drop("_s", "_b", "block_count", "block_sizes", "block_starts")


def split_name(df: DataFrame, names: list[str], column: str = "name") -> DataFrame:
    """A compound name ``a:b:c`` as columns of its own."""
    parts = F.split(column, ":")
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(names)})


def read_peaks(spark: SparkSession, path: str, kind: str = "narrowPeak") -> DataFrame:
    return read_bed(spark, path, PEAKS[kind])


def read_bedpe(spark: SparkSession, path: str) -> DataFrame:
    """chrom1, start1, end1, chrom2, start2, end2, name, score, strand1, strand2."""
    names = ["chrom1", "start1", "end1", "chrom2", "start2", "end2", "name", "score", "strand1", "strand2"]
    out = _columns(spark.read.text(path), names)
    return out.withColumns({c: F.expr(f"try_cast({c} AS bigint)") for c in ("start1", "end1", "start2", "end2")})


def _attribute(text: Column, key: str) -> Column:
    got = F.regexp_extract(text, rf'(?:^|[;\s]){key}[\s=]+"?([^";]+)"?', 1)
    return F.when(got != "", got)


def read_gtf(spark: SparkSession, path: str, feature: str = "exon") -> DataFrame:
    """Rows of one feature: coordinates, strand, gene and transcript attributes."""
    out = _columns(spark.read.text(path), ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"])
    a = F.col("attributes")
    keys = ("gene_id", "gene_name", "gene_type", "transcript_id", "transcript_name", "transcript_type")
    return out.filter(F.col("feature") == feature).select("chrom", (F.col("start") - 1).alias("start"), "end", "strand", *(_attribute(a, k).alias(k) for k in keys))


def read_gff3_mirna(spark: SparkSession, path: str, mode: str = "primary") -> DataFrame:
    """Primary transcripts or mature miRNAs of a GFF3 file as BED6 with a compound name."""
    kind = "miRNA_primary_transcript" if mode == "primary" else "miRNA"
    out = _columns(spark.read.text(path), ["chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes"])
    tags = F.str_to_map("attributes", F.lit(";"), F.lit("="))
    parent = F.coalesce(F.try_element_at(tags, F.lit("Derives_from")), F.lit("NA"))
    name = F.concat_ws(":", F.try_element_at(tags, F.lit("ID")), F.try_element_at(tags, F.lit("Name")), parent, F.col("feature"))
    return out.filter(F.col("feature") == kind).select("chrom", (F.col("start") - 1).alias("start"), "end", name.alias("name"), F.lit(0.0).alias("score"), "strand")


def mirna_to_gtf(mature: DataFrame, primary: DataFrame) -> DataFrame:
    """Gene, transcript and exon rows of each mature miRNA, with its parent's name."""
    m = split_name(mature, ["id", "mirna", "parent", "type"])
    p = split_name(primary, ["pid", "gene"]).select(F.col("pid").alias("parent"), F.col("gene"))
    both = m.join(p, "parent", "left")
    return both.select("chrom", F.explode(F.array(*map(F.lit, ("gene", "transcript", "exon")))).alias("feature"), (F.col("start") + 1).alias("start"), "end", "strand", F.coalesce("gene", "mirna").alias("gene_name"), F.col("id").alias("transcript_id"))


def read_fasta(spark: SparkSession, path: str, keep: str | None = None) -> DataFrame:
    """id, seq of every record: records are separated by '>' at the start of a line, so a record is one row whatever its lines."""
    rec = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter(F.length(F.trim("value")) > 0)
    out = rec.select(F.regexp_extract("value", r"^(\S+)", 1).alias("id"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "").alias("seq"))
    return out.filter(F.col("id").rlike(keep)) if keep else out


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 0 inside each file), value. Counts per block of a file are carried over, lines are not sorted."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))
    per = lines.groupBy("file", "block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return lines.join(per, ["file", "block"]).select("file", (F.col("_id") - F.col("_first") + F.col("_before")).alias("line"), "value")


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """Four-line records: file, record, id, seq, qual; incomplete records are dropped."""
    lines = numbered_lines(spark, path).withColumns({"record": F.floor(F.col("line") / 4), "part": F.col("line") % 4})
    pick = lambda k: F.max(F.when(F.col("part") == k, F.col("value")))
    out = lines.groupBy("file", "record").agg(pick(0).alias("h"), pick(1).alias("seq"), pick(3).alias("qual"))
    return out.filter(F.col("h").startswith("@") & F.col("qual").isNotNull()).select("file", "record", F.regexp_extract("h", r"^@(\S+)", 1).alias("id"), "seq", "qual")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignment lines with typed columns and a map of tags; header lines are skipped."""
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"]
    kinds = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}
    rows = spark.read.text(path).filter(~F.col("value").startswith("@")).withColumn("_p", F.split("value", "\t")).filter(F.size("_p") >= 11)
    tags = F.map_from_entries(F.transform(F.slice("_p", F.lit(12), F.greatest(F.size("_p") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^..:.:", ""))))
    return rows.select(*(F.expr(f"try_cast(_p[{i}] AS {kinds[n]})").alias(n) if n in kinds else F.expr(f"_p[{i}]").alias(n) for i, n in enumerate(names)), tags.alias("tags"))


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return _columns(spark.read.text(path), ["chrom", "length"])


def read_gene_info(spark: SparkSession, path: str) -> DataFrame:
    """Ensembl id, symbol, description and type of NCBI gene_info rows; '-' becomes null."""
    names = ["tax", "entrez", "symbol", "locus", "synonyms", "xrefs", "chromosome", "map", "description", "type"]
    out = _columns(spark.read.text(path), names)
    ens = F.regexp_extract("xrefs", r"Ensembl:([^|]+)", 1)
    clean = lambda c: F.when(F.col(c) != "-", F.col(c)).alias(c)
    return out.select(F.when(ens != "", ens).alias("gene_id"), clean("symbol"), clean("synonyms"), clean("description"), clean("type"))


def read_results_dir(spark: SparkSession, path: str, glob: str = "*", keep: str | None = None, drop: str | None = None, name: str = r"([^/]+?)(?:\.[^/.]*)?$", sep: str = "\t") -> DataFrame:
    """Headered result files below a folder as one table, with ``sample`` taken from the file name."""
    out = spark.read.option("header", True).option("sep", sep).option("recursiveFileLookup", True).option("pathGlobFilter", glob).csv(path)
    file = F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1)
    out = out.select("*", F.regexp_extract("_metadata.file_path", name, 1).alias("sample"), file.alias("_file"))
    if keep:
        out = out.filter(F.col("_file").rlike(keep))
    if drop:
        out = out.filter(~F.col("_file").rlike(drop))
    return out.drop("_file")


def read_cycles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Segment rows and ordered, signed cycle steps of amplicon files; breakpoints (segment 0) are dropped."""
    lines = spark.read.text(path).select("value", F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("sample"))
    seg = lines.filter(F.col("value").startswith("Segment\t")).withColumn("_p", F.split("value", "\t"))
    segments = seg.select("sample", *(F.expr(f"_p[{i}]").cast(t).alias(n) for i, n, t in ((1, "segment", "int"), (2, "chrom", "string"), (3, "start", "bigint"), (4, "end", "bigint"))))
    cyc = lines.filter(F.col("value").startswith("Cycle="))
    cyc = cyc.select("sample", F.regexp_extract("value", r"Cycle=(\d+)", 1).cast("int").alias("cycle"), F.regexp_extract("value", r"Copy_count=([\d.]+)", 1).cast("double").alias("copies"), F.regexp_extract("value", r"Segments=([^;\s]+)", 1).alias("path"))
    cyc = cyc.dropDuplicates(["sample", "path"])
    steps = cyc.select("sample", "cycle", "copies", F.posexplode(F.split("path", ",")).alias("ord", "_s"))
    steps = steps.select("sample", "cycle", "copies", "ord", F.regexp_extract("_s", r"(\d+)", 1).cast("int").alias("segment"), F.substring("_s", -1, 1).alias("strand"))
    return segments, steps.filter("segment > 0")


def read_meth_calls(spark: SparkSession, path: str) -> DataFrame:
    """read, meth, chrom, pos, call; the version line is skipped."""
    rows = spark.read.text(path).withColumn("_p", F.split("value", "\t")).filter(F.size("_p") == 5)
    return rows.select(F.expr("_p[0]").alias("read"), (F.expr("_p[1]") == "+").alias("meth"), F.expr("_p[2]").alias("chrom"), F.expr("try_cast(_p[3] AS bigint)").alias("pos"), F.expr("_p[4]").alias("call"))


def read_cov(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, start bigint, end bigint, pct double, meth bigint, unmeth bigint").option("sep", "\t").csv(path)


def read_cx_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, pos bigint, strand string, meth bigint, unmeth bigint, context string, tri string").option("sep", "\t").csv(path)


#: Patterns of metrics in tool logs, by kind; group 1 is the value.
METRICS = {
    "star": {"input_reads": r"Number of input reads \|\s*(\d+)", "unique_reads": r"Uniquely mapped reads number \|\s*(\d+)", "unique_percent": r"Uniquely mapped reads % \|\s*([\d.]+)%", "multi_reads": r"Number of reads mapped to multiple loci \|\s*(\d+)"},
    "flagstat": {"total": r"(\d+) \+ \d+ in total", "duplicates": r"(\d+) \+ \d+ duplicates", "mapped": r"(\d+) \+ \d+ mapped \(", "properly_paired": r"(\d+) \+ \d+ properly paired", "singletons": r"(\d+) \+ \d+ singletons"},
    "samstats": {"reads": r"SN\s+raw total sequences:\s*(\d+)", "mapped": r"SN\s+reads mapped:\s*(\d+)", "error_rate": r"SN\s+error rate:\s*([\d.e+-]+)", "average_length": r"SN\s+average length:\s*(\d+)"},
    "pbc": {k: r"^" + r"\S+\s+" * i + r"(\S+)" for i, k in enumerate(("total", "distinct", "one", "two", "nrf", "pbc1", "pbc2"))},
    "spp": {k: r"^" + r"[^\t]*\t" * i + r"([^\t\n]+)" for i, k in ((1, "reads"), (2, "fragment"), (4, "phantom"), (8, "nsc"), (9, "rsc"), (10, "tag"))},
    "hotspot": {"total": r"\n\s*(\d+)\s+\d+\s+[\d.]+", "hotspot_tags": r"\n\s*\d+\s+(\d+)\s+[\d.]+", "spot": r"\n\s*\d+\s+\d+\s+([\d.]+)"},
}


def collect_tool_metrics(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """sample, source, metric, value for all logs of a kind below a folder, in one job."""
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    files = files.select("value", F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^/]*)?$", 1).alias("sample"))
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.regexp_extract("value", p, 1).alias("value")) for m, p in METRICS[kind].items())))
    return files.select("sample", F.lit(kind).alias("source"), pairs.alias("m")).select("sample", "source", "m.*").filter("value <> ''")


def merge_qc_summary(metrics: DataFrame, names: list[str]) -> DataFrame:
    """One row per sample with a column per metric."""
    return metrics.groupBy("sample").pivot("metric", names).agg(F.first("value"))


def read_cluster_csv(spark: SparkSession, path: str, min_locations: int = 1, min_events: int = 1, min_reads: int = 1, drop_repeats: bool = False) -> DataFrame:
    """Cluster rows (headered CSV) that pass the thresholds, as BED6 with starts of at least 0."""
    c = spark.read.option("header", True).csv(path)
    n = lambda name: F.expr(f"try_cast(`{name}` AS double)")
    ok = (n("ConversionLocationCount") >= min_locations) & (n("ConversionEventCount") >= min_events) & (n("ReadCount") >= min_reads)
    if drop_repeats and "Repeat" in c.columns:
        ok = ok & (F.coalesce("Repeat", F.lit("")) == "")
    return c.filter(ok).select(F.col("Chromosome").alias("chrom"), F.greatest(n("ClusterStart").cast("long") - 1, F.lit(0)).alias("start"), n("ClusterEnd").cast("long").alias("end"), F.col("ClusterID").alias("name"), n("ReadCount").alias("score"), F.col("Strand").alias("strand"))


def to_ucsc_names(df: DataFrame, column: str = "chrom") -> DataFrame:
    """Names with ``chr`` in front; MT becomes chrM."""
    c = F.col(column)
    return df.withColumn(column, F.when(c == "MT", "chrM").when(c.startswith("chr"), c).otherwise(F.concat(F.lit("chr"), c)))


def write_tsv(df: DataFrame, path: str, by: list[str] | None = None, header: bool = True, compression: str = "gzip") -> None:
    """Tab-separated output, one folder per value of ``by``."""
    out = df.write.mode("overwrite").option("sep", "\t").option("header", header).option("compression", compression)
    (out.partitionBy(*by) if by else out).csv(path)


def write_bedgraph(df: DataFrame, path: str, value: str) -> None:
    write_tsv(df.select("chrom", "start", "end", value).sortWithinPartitions("chrom", "start"), path, header=False)


def write_fasta_by_chrom(df: DataFrame, path: str, keep: str = r"^chr(\d+|X|Y|M)$") -> None:
    """One folder per kept sequence, with its record as text."""
    kept = df.filter(F.col("id").rlike(keep))
    kept.select(F.concat(F.lit(">"), "id", F.lit("\n"), "seq").alias("value"), F.col("id").alias("chrom")).write.mode("overwrite").partitionBy("chrom").text(path)
