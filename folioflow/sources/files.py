"""File sources and sinks: chunk and embedding JSON lines with manifests, id lists, folders, evaluation sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = (
    "chunk_id string, paper_id string, chunk_index bigint, text string, char_count bigint, content_sha256 string, page_start bigint, page_end bigint, section_path array<string>, "
    "source_markdown_relative_path string, source_markdown_sha256 string, source_pdf_sha256 string, source_parser_name string, source_parser_version string, splitter_name string, splitter_version string, "
    "splitter_options map<string,bigint>, schema_version bigint"
)
EMBEDDING = (
    "embedding_id string, chunk_id string, paper_id string, embedding_model string, embedding_model_version string, embedding_dimension bigint, vector array<double>, source_chunk_sha256 string, text_hash string, "
    "source_path string, metadata map<string,string>, schema_version bigint"
)
EVALUATION = (
    "dataset_id string, cases array<struct<case_id:string,query:string,description:string,tags:array<string>,candidate_paper_ids:array<string>,"
    "judgments:array<struct<paper_id:string,relevance:bigint,rationale:string>>>>"
)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and the lines that don't as ``file, line``. Folders are read with their subfolders."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), "value")
    parsed = lines.select("file", "value", F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    return parsed.where("r._corrupt is null").select("r.*").drop("_corrupt"), parsed.where("r._corrupt is not null").select("file", F.col("value").alias("line"))


def write_json_lines(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """One compact JSON object a line with its keys sorted, nulls kept."""
    others = sorted(c for c in df.columns if c not in partition_by)
    line = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias("value")
    writer = df.select(*partition_by, line).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_chunk_assets(chunks: DataFrame, path: str) -> DataFrame:
    """Writes the chunks of papers whose content is new or changed, and returns ``paper_id, status``: written or reused.

    A paper's content is the hash of its lines in order of chunk_index; the hashes lie beside the chunks. Changed papers are written as a new
    batch folder, so a run that fails leaves the earlier ones whole; ``read_chunk_assets`` takes each paper's latest batch.
    """
    spark = chunks.sparkSession
    line = F.to_json(F.struct(*sorted(chunks.columns)), {"ignoreNullFields": "false"})
    new = chunks.groupBy("paper_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", line.alias("l")))), lambda x: x["l"]), "\n"), 256).alias("hash"))
    try:
        old = spark.read.schema("paper_id string, hash string, batch bigint").json(f"{path}/hashes")
        latest = old.groupBy("paper_id").agg(F.max_by("hash", "batch").alias("old"))
        batch = (old.agg(F.max("batch")).first()[0] or 0) + 1
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        latest, batch = spark.createDataFrame([], "paper_id string, old string"), 1
    from folioflow.session import cut_lineage

    status = cut_lineage(new.join(latest, "paper_id", "left").select("paper_id", "hash", F.when(F.col("hash") == F.col("old"), "reused").otherwise("written").alias("status")))
    fresh = status.where("status = 'written'")
    write_json_lines(chunks.join(fresh.select("paper_id"), "paper_id", "left_semi"), f"{path}/chunks/batch={batch}")
    fresh.select("paper_id", "hash", F.lit(batch).alias("batch")).write.mode("append").json(f"{path}/hashes")
    return status.select("paper_id", "status")


def read_chunk_assets(spark: SparkSession, path: str, paper_ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The chunks of the requested papers (all without a request) from their latest batch, and the requested ids that have none."""
    latest = spark.read.schema("paper_id string, hash string, batch bigint").json(f"{path}/hashes").groupBy("paper_id").agg(F.max("batch").alias("batch"))
    lines = spark.read.text(f"{path}/chunks")
    chunks = lines.select(F.from_json("value", CHUNK).alias("r"), F.col("batch").cast("bigint").alias("batch")).select("r.*", "batch").join(latest, ["paper_id", "batch"], "left_semi").drop("batch")
    if paper_ids is None:
        return chunks, latest.select("paper_id").limit(0)
    wanted = paper_ids.select(F.col(paper_ids.columns[0]).alias("paper_id")).distinct()
    return chunks.join(wanted, "paper_id", "left_semi"), wanted.join(latest, "paper_id", "left_anti")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """``position, paper_id``: the ids of a text file in order, each once; blank lines and lines that begin with # don't count, ids with slashes are left out."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("position", "line"))
    ids = lines.select("position", F.trim("line").alias("paper_id")).where((F.col("paper_id") != "") & ~F.col("paper_id").startswith("#") & ~F.col("paper_id").rlike(r"[/\\]"))
    return ids.groupBy("paper_id").agg(F.min("position").alias("position")).select("position", "paper_id")


def folder_statistics(spark: SparkSession, path: str) -> DataFrame:
    """``suffix, files, bytes`` of a folder with its subfolders; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.groupBy(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).alias("suffix")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def pdf_reasons(spark: SparkSession, path: str, least_bytes: int = 1024) -> DataFrame:
    """``path, bytes, sha256, reason``: PDF files with the first rule they break (too_small, bad_header), null if none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pdf").load(path)
    reason: Column = F.when(F.col("length") < least_bytes, "too_small").when(F.substring(F.col("content"), 1, 5) != F.lit(b"%PDF-"), "bad_header")
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), reason.alias("reason"))


def read_evaluation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Cases (``case_id, query, tags``) and judgments (``case_id, paper_id, relevance`` for every candidate, 0 where unjudged) of a dataset file."""
    cases = spark.read.option("multiLine", "true").schema(EVALUATION).json(path).select(F.explode("cases").alias("c"))
    grades = F.map_from_entries(F.transform("c.judgments", lambda j: F.struct(j["paper_id"], j["relevance"])))
    every = cases.select("c.case_id", grades.alias("g"), F.explode("c.candidate_paper_ids").alias("paper_id"))
    return cases.select("c.case_id", "c.query", "c.tags"), every.select("case_id", "paper_id", F.coalesce(F.try_element_at("g", F.col("paper_id")), F.lit(0)).alias("relevance"))


def read_ready_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """``position, paper_id, title`` of a saved workflow's outcomes that are ready, each paper once at its first place."""
    schema = "topic string, outcomes array<struct<paper_id:string,title:string,ready:boolean>>"
    rows = spark.read.option("multiLine", "true").schema(schema).json(path).select(F.posexplode("outcomes").alias("position", "o")).where("o.ready")
    return rows.groupBy("o.paper_id").agg(F.min("position").alias("position"), F.min_by("o.title", "position").alias("title")).select("position", "paper_id", "title")
