"""Text formats: lines with their place in the file, and the record readers built on them.

Spark reads a file in blocks and keeps a block's lines in order. A line's number is the number of lines in the file's blocks
before its own, which is a sum over a small table of blocks, and its place in the block; no file is read by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.operators.matrix import numbered_rows
from helixframe.operators.scratch import scratch_path

#: Lines that are numbered together; a file has many such runs.
RUN_LINES = 1 << 14


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, line) of all text files at the path; ordinals count from 0 in each file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    bases = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("base"))
    return lines.join(bases, ["file", "block"]).select("file", (F.col("base") + F.col("id")).alias("ordinal"), "line")


def write_text(rows: DataFrame, name: str) -> str:
    """Writes a table of one text column to a scratch folder and returns its path. A value may hold several lines."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.text(path)
    return path


def write_shards(rows: DataFrame, order: list[str], name: str, header: str | None = None) -> str:
    """Writes (shard, ..., line) sorted by `order` inside each shard and returns the folder; a header line begins each shard.

    A shard may have several files: their numbers carry the order on.
    """
    body = rows.withColumn("__body", F.lit(1))
    if header is not None:
        heads = rows.select("shard").distinct().withColumn("line", F.lit(header)).withColumn("__body", F.lit(0))
        body = body.unionByName(heads, allowMissingColumns=True)
    by = ["shard", "__body", *order]
    path = scratch_path(rows.sparkSession, name)
    body.repartitionByRange(*by).sortWithinPartitions(*by).select("shard", "line").write.partitionBy("shard").text(path)
    return path


def ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(shard, place, line) of text files as one sequence: by shard, then by the files' numbers; place counts from 0 over all."""
    lines = read_lines(spark, path)
    shard = F.expr("try_cast(nullif(regexp_extract(file, '/shard=([^/]*)/', 1), '') as int)")
    files = lines.groupBy("file").agg(F.count("*").alias("n")).withColumn("shard", shard).withColumn("part", F.regexp_extract("file", r"part-([0-9]+)[^/]*$", 1).cast("long"))
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("shard").asc_nulls_first(), "part", "file").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    bases = files.select("file", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return lines.join(bases, "file").select("shard", (F.col("base") + F.col("ordinal")).alias("place"), "line")


def concat_shards(spark: SparkSession, path: str, name: str, header_mark: str | None = None) -> str:
    """Writes all shards one after the other and returns the folder, whose files in order are the result; with header_mark, lines
    that begin with it are kept from the first shard only."""
    lines = ordered_lines(spark, path)
    if header_mark is not None:
        first = lines.agg(F.min("shard").alias("s")).select("s").scalar()
        lines = lines.withColumn("__first", first).where(~F.col("line").startswith(header_mark) | (F.col("shard") == F.col("__first")))
    out = scratch_path(spark, name)
    lines.repartitionByRange("place").sortWithinPartitions("place").select("line").write.text(out)
    return out


def check_read_lists(first: DataFrame, second: DataFrame, ranks: int) -> DataFrame:
    """(list, n, remainder): how many files two lists of read files have (a line each), and what is left modulo the ranks."""
    named = first.select(F.lit(1).alias("list")).unionAll(second.select(F.lit(2)))
    return named.groupBy("list").agg(F.count("*").alias("n")).withColumn("remainder", F.col("n") % ranks)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path) of all files below a folder; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")


def missing_shards(spark: SparkSession, expected: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of expected (.., name) of which no file's path holds the folder `/name/`."""
    found = files.select(F.explode(F.split("path", "/")).alias("name")).distinct()
    return expected.join(found, "name", "left_anti")


def require_shards(spark: SparkSession, expected: DataFrame, files: DataFrame) -> None:
    """An error that names a missing shard, if one is missing."""
    lost = missing_shards(spark, expected, files).select("name").orderBy("name").first()
    if lost:
        raise FileNotFoundError(f"missing shard: {lost['name']}")


def read_constraints(spark: SparkSession, path: str) -> DataFrame:
    """(name, chain, pos) from lines of JSON {name: {chain: [positions]}}."""
    names = spark.read.text(path).where("value <> ''").select(F.explode(F.from_json("value", "map<string,map<string,array<int>>>")).alias("name", "chains"))
    return names.select("name", F.explode("chains").alias("chain", "places")).select("name", "chain", F.explode("places").alias("pos"))


def records(lines: DataFrame, size: int) -> DataFrame:
    """(file, record, l0, l1, ...): every `size` lines of a file are a record; what is missing at the end is null."""
    at = [F.max(F.when(F.col("ordinal") % size == i, F.col("line"))).alias(f"l{i}") for i in range(size)]
    return lines.groupBy("file", F.floor(F.col("ordinal") / size).alias("record")).agg(*at)


def _numbered_records(lines: DataFrame, head: Column) -> DataFrame:
    """Adds head and record, the number of heads up to a line in its file: counted in runs of lines, which are then added up."""
    flagged = lines.withColumn("head", head).withColumn("run", F.floor(F.col("ordinal") / RUN_LINES))
    runs = flagged.groupBy("file", "run").agg(F.sum(F.col("head").cast("int")).alias("n"))
    before = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    bases = runs.select("file", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = F.sum(F.col("head").cast("int")).over(Window.partitionBy("file", "run").orderBy("ordinal"))
    return flagged.withColumn("within", within).join(bases, ["file", "run"]).withColumn("record", F.col("base") + F.col("within")).drop("run", "base", "within")


def _fasta_lines(spark: SparkSession, path: str, marker: str | None) -> DataFrame:
    begins = F.col("line").contains(marker) if marker else F.col("line").startswith(">")
    numbered = _numbered_records(read_lines(spark, path), begins)
    stray = (F.col("record") == 0) & (F.trim("line") != "")
    return numbered.withColumn("record", F.when(stray, F.raise_error(F.lit("a sequence line before any header"))).otherwise(F.col("record"))).where("record > 0")


_HEADER = "max(if(head, regexp_replace(trim(line), '^>', ''), null))"


def read_fasta(spark: SparkSession, path: str, marker: str | None = None) -> DataFrame:
    """(file, record, header, seq). A record begins at a line that starts with `>` or, if given, holds the marker.

    A line of sequence before any header is an error. A record's sequence is one value, and so are its lines on their way.
    """
    parts = F.sort_array(F.collect_list(F.when(~F.col("head"), F.struct("ordinal", F.trim("line").alias("text")))))
    return _fasta_lines(spark, path, marker).groupBy("file", "record").agg(F.expr(_HEADER).alias("header"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("seq"))


def fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, header, length) of FASTA records as sums of their lines' lengths; no sequence is put together."""
    size = F.sum(F.when(F.col("head"), 0).otherwise(F.length(F.trim("line"))))
    return _fasta_lines(spark, path, None).groupBy("file", "record").agg(F.expr(_HEADER).alias("header"), size.cast("long").alias("length"))


def read_sam(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header lines (ordinal, line) and rows (ordinal, name, flag, contig, pos, mapq, line)."""
    lines = read_lines(spark, path)
    head = F.col("line").startswith("@")
    f = F.split("line", "\t")
    rows = lines.where(~head & (F.col("line") != "")).select("file", "ordinal", f[0].alias("name"), f[1].cast("int").alias("flag"), f[2].alias("contig"), f[3].cast("long").alias("pos"), f[4].cast("int").alias("mapq"), "line")
    return lines.where(head), rows


def contig_table(header: DataFrame) -> DataFrame:
    """(ord, contig, length) from `@SQ` lines; a name is all that follows the first colon of its field."""
    sq = header.where(F.col("line").startswith("@SQ"))
    name, length = F.regexp_extract("line", r"\tSN:([^\t]*)", 1), F.regexp_extract("line", r"\tLN:([0-9]+)", 1).cast("long")
    return sq.select(F.row_number().over(Window.partitionBy("file").orderBy("ordinal")).alias("n"), name.alias("contig"), length.alias("length")).select((F.col("n") - 1).alias("ord"), "contig", "length")


def read_fai(spark: SparkSession, path: str, primary: int = 25) -> DataFrame:
    """(ord, contig, length, is_primary): the first rows of the index are the primary contigs."""
    f = F.split("line", "\t")
    return read_lines(spark, path).where("line <> ''").select(F.col("ordinal").alias("ord"), f[0].alias("contig"), f[1].cast("long").alias("length"), (F.col("ordinal") < primary).alias("is_primary"))


def read_matrix_market(spark: SparkSession, path: str) -> DataFrame:
    """(cell_id, gene_id, value), both ids as the text's row and column, from coordinate text; comments and the size line after them are dropped, explicit zeros stay.

    A part without a comment at its beginning has no size line.
    """
    f = F.split("line", r"\s+")
    lines = read_lines(spark, path)
    sized = lines.groupBy("file").agg((F.coalesce(F.max(F.when(F.col("line").startswith("%"), F.col("ordinal"))), F.lit(-2)) + 1).alias("size_line"))
    return lines.join(sized, "file").where(F.col("ordinal") > F.col("size_line")).select(f[0].try_cast("long").alias("cell_id"), f[1].try_cast("long").alias("gene_id"), f[2].try_cast("double").alias("value"))


def write_matrix_market(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> str:
    """Writes coordinate text with a header and a size line, and the axes' annotations; returns the folder.

    cells: (cell_id, label), genes: (gene_id, label). The n-th line of `cells` and `genes` names the n-th row and column.
    """
    spark = counts.sparkSession
    folder = scratch_path(spark, "matrix")
    axes = {}
    for name, table, key in (("cells", cells, "cell_id"), ("genes", genes, "gene_id")):
        axes[name] = numbered_rows(table, key)
        axes[name].repartitionByRange("row").sortWithinPartitions("row").select(F.concat_ws("\t", key, "label")).write.text(f"{folder}/{name}")
    place = lambda name, key, out: axes[name].select(key, (F.col("row") + 1).alias(out))
    entries = counts.join(place("cells", "cell_id", "i"), "cell_id").join(place("genes", "gene_id", "j"), "gene_id").select(F.concat_ws(" ", "i", "j", "value").alias("line"))
    sizes = [axes["cells"].count(), axes["genes"].count(), counts.count()]
    head = spark.range(1, numPartitions=1).select(F.lit("%%MatrixMarket matrix coordinate real general\n% rows are cells, columns are genes\n" + " ".join(map(str, sizes))).alias("line"))
    head.unionAll(entries).write.text(f"{folder}/matrix")
    return folder


def read_annotated_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """(cell_id, gene_id, value, cell_label, gene_label) of a folder as written above; explicit zeros stay."""
    f = F.split("line", "\t")
    axis = lambda name, n: ordered_lines(spark, f"{folder}/{name}").select((F.col("place") + 1).alias(n), f[0].cast("long").alias(f"__{n}"), f[1].alias(f"{name[:-1]}_label"))
    entries = read_matrix_market(spark, f"{folder}/matrix")
    joined = entries.join(axis("cells", "cell_id"), "cell_id").join(axis("genes", "gene_id"), "gene_id")
    return joined.select(F.col("__cell_id").alias("cell_id"), F.col("__gene_id").alias("gene_id"), "value", "cell_label", "gene_label")


def read_tsv(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = (), header: bool = True) -> DataFrame:
    """Tab-separated text with a header; a missing required column is an error."""
    if header and required:
        have = spark.read.option("sep", "\t").option("header", True).csv(path).columns
        missing = [c for c in required if c not in have]
        if missing:
            raise ValueError(f"missing columns: {missing}")
    return spark.read.schema(schema).option("sep", "\t").option("header", header).csv(path)


def read_intervals(spark: SparkSession, path: str, skip: int = 0) -> DataFrame:
    """(contig, start_pos, end_pos, value) from peak files; the first `skip` lines of each file are headers."""
    f = F.split("line", "\t")
    return read_lines(spark, path).where((F.col("ordinal") >= skip) & (F.col("line") != "")).select(f[0].alias("contig"), f[1].cast("long").alias("start_pos"), f[2].cast("long").alias("end_pos"), f[6].cast("double").alias("value"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, job, receptor, ligand, name): three lines per job; an unfinished last job is dropped."""
    jobs = records(read_lines(spark, path), 3).where("l2 is not null")
    return jobs.select("file", F.col("record").alias("job"), F.col("l0").alias("receptor"), F.col("l1").alias("ligand"), F.col("l2").alias("name"))
