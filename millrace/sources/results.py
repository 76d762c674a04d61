"""Scans: result trees of evaluation runs, feedback, front matter, files and event lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import schemas

#: Folders that hold no runs, names beside the outputs, and types by file extension.
PRUNED = ("node_modules", ".git", "__pycache__", "skill", "inputs")
BESIDE = ("transcript.md", "user_notes.md", "metrics.json")
TEXT_TYPES = ("txt", "md", "json", "csv", "py", "js", "ts", "tsx", "jsx", "yaml", "yml", "xml", "html", "css", "sh", "rb", "go", "rs", "java", "c", "cpp", "h", "hpp", "sql", "r", "toml")
IMAGE_TYPES = ("png", "jpg", "jpeg", "gif", "svg", "webp")
OFFICE = "application/vnd.openxmlformats-officedocument"
MIME = {
    "svg": "image/svg+xml", "xlsx": f"{OFFICE}.spreadsheetml.sheet", "docx": f"{OFFICE}.wordprocessingml.document", "pptx": f"{OFFICE}.presentationml.presentation", "png": "image/png", "jpg": "image/jpeg",
    "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "pdf": "application/pdf", "zip": "application/zip", "txt": "text/plain", "csv": "text/csv", "html": "text/html", "json": "application/json",
}


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, glob: str) -> bool:
    store, path = _store(spark, glob)
    found = store.globStatus(path)
    return found is not None and len(found) > 0


def read_documents(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """JSON documents, one a file, with _path; none where nothing fits the glob."""
    if not _exists(spark, glob):
        return spark.createDataFrame([], f"{schema}, _path string")
    # whole texts and from_json: a JSON scan of which only the corrupt column is used is refused
    raw = spark.read.text(glob, wholetext=True).select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("j"), F.col("_metadata.file_path").alias("_path"))
    return raw.select("j.*", "_path")


def _folders(spark: SparkSession, glob: str) -> list[str]:
    """Names of the folders that fit a glob, sorted."""
    store, path = _store(spark, glob)
    return sorted(x.getPath().getName() for x in store.globStatus(path) or [] if x.isDirectory())


def scan_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run of a tree <root>[/runs]/eval-*/<configuration>/run-*/grading.json, with the defaults for what is missing.

    Corrupt files and runs whose number isn't one have a reason in `rejected`; keep the rows where it is null.
    """
    top = f"{root}/runs" if _exists(spark, f"{root}/runs") else root
    parts = F.split("_path", "/")
    grading = read_documents(spark, f"{top}/eval-*/*/run-*/grading.json", schemas.GRADING)
    grading = grading.withColumns({"eval_dir": F.element_at(parts, -4), "configuration": F.element_at(parts, -3), "run_dir": F.element_at(parts, -2)})
    meta = read_documents(spark, f"{top}/eval-*/eval_metadata.json", schemas.METADATA).select(F.element_at(F.split("_path", "/"), -2).alias("eval_dir"), F.col("eval_id").alias("meta_id"), F.col("eval_name"), F.lit(True).alias("has_meta"))
    timing = read_documents(spark, f"{top}/eval-*/*/run-*/timing.json", schemas.TIMING).select(*[F.element_at(F.split("_path", "/"), -k).alias(c) for k, c in ((4, "eval_dir"), (3, "configuration"), (2, "run_dir"))], F.col("total_tokens").alias("t_tokens"), F.col("total_duration_seconds").alias("t_seconds"))
    order = spark.createDataFrame(list(enumerate(_folders(spark, f"{top}/eval-*"))), "eval_idx long, eval_dir string")  # all of them, those without runs too
    x = grading.join(order, "eval_dir").join(meta, "eval_dir", "left").join(timing, ["eval_dir", "configuration", "run_dir"], "left")
    number = F.expr("try_cast(regexp_extract(eval_dir, '^eval-([^-]*)', 1) AS bigint)")
    own = F.coalesce("timing.total_duration_seconds", F.lit(0.0))
    side = own == 0.0
    tokens = F.when(side, F.coalesce("t_tokens", F.lit(0))).otherwise(F.lit(0))
    chars = F.coalesce("execution_metrics.output_chars", F.lit(0))
    notes = F.concat(*[F.coalesce(F.col(f"user_notes_summary.{k}"), F.array().cast("array<string>")) for k in ("uncertainties", "needs_review", "workarounds")])
    run_number = F.expr("try_cast(regexp_extract(run_dir, '^run-([^-]*)', 1) AS int)")
    rejected = F.when(F.col("_corrupt_record").isNotNull(), "corrupt").when(run_number.isNull(), "run number")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return x.select(
        "configuration", F.when(F.col("has_meta"), F.coalesce("meta_id", "eval_idx")).otherwise(F.coalesce(number, F.col("eval_idx"))).alias("eval_id"), "eval_name", "eval_dir", run_number.alias("run_number"),
        F.coalesce("summary.pass_rate", F.lit(0.0)).alias("pass_rate"), zero("summary.passed").alias("passed"), zero("summary.failed").alias("failed"), zero("summary.total").alias("total"),
        F.when(side, F.coalesce("t_seconds", F.lit(0.0))).otherwise(own).alias("time_seconds"),
        F.when(tokens != 0, tokens).otherwise(chars).alias("tokens"), F.when(tokens != 0, "timing").otherwise("output_chars").alias("tokens_source"),
        zero("execution_metrics.total_tool_calls").alias("tool_calls"), zero("execution_metrics.errors_encountered").alias("errors"), "expectations", notes.alias("notes"),
        F.exists(F.coalesce("expectations", F.array().cast(schemas.EXPECTATIONS)), lambda e: e["text"].isNull() | e["passed"].isNull()).alias("bad_expectation"), "claims", rejected.alias("rejected"),
    )


def read_feedback(spark: SparkSession, path: str) -> DataFrame:
    """run_id, feedback: blank feedback and rows without run id left out; of a repeated run id the last stays."""
    rows = read_documents(spark, path, schemas.FEEDBACK).filter("_corrupt_record is null").select(F.posexplode("reviews").alias("at", "r"))
    rows = rows.select("at", "r.run_id", "r.feedback").filter((F.regexp_replace("feedback", r"^\s+|\s+$", "") != "") & F.col("run_id").isNotNull())
    return rows.groupBy("run_id").agg(F.max_by("feedback", "at").alias("feedback"))


def find_runs(spark: SparkSession, root: str) -> DataFrame:
    """run_dir (relative to root), run_id: folders with an outputs folder, empty or not; nothing below them or a pruned folder is looked at."""
    store, top = _store(spark, root)
    found, todo = [], [(top, "")]
    while todo:  # a listing of folders, as of any scan
        path, rel = todo.pop()
        inside = [x.getPath() for x in store.listStatus(path) if x.isDirectory()] if store.exists(path) else []
        if any(x.getName() == "outputs" for x in inside):
            found.append((rel or ".",))
        else:
            todo += [(x, f"{rel}/{x.getName()}".lstrip("/")) for x in inside if x.getName() not in PRUNED]
    runs = spark.createDataFrame(found, "run_dir string")
    return runs.withColumn("run_id", run_id(F.col("run_dir")))


def _relative(spark: SparkSession, root: str) -> Column:
    """The scanned file's path below root."""
    store, path = _store(spark, root)
    top = store.makeQualified(path).toString().rstrip("/")
    plain = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"), F.lit("+"), F.lit("%2B")))
    return F.substring(plain, len(top.replace("file:///", "file:/")) + 2, 1 << 20)


def scan_outputs(spark: SparkSession, root: str) -> DataFrame:
    """Files directly in the outputs folder of each run, but for what is written beside them: run_dir, run_id, name, kind, mime, data."""
    rel = _relative(spark, root)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(rel.alias("rel"), "content")
    name = F.element_at(F.split("rel", "/"), -1)
    own = F.regexp_extract(F.concat(F.lit("./"), "rel"), "^(.*)/outputs/[^/]*$", 1)
    files = files.withColumns({"run_dir": F.when(own == ".", ".").otherwise(F.regexp_replace(own, r"^\./", "")), "name": name}).filter(~F.col("name").isin(*BESIDE))
    return files.join(find_runs(spark, root), "run_dir").select("run_dir", "run_id", "name", *embedded(F.col("name"), F.col("content")))


def review_runs(spark: SparkSession, root: str) -> DataFrame:
    """run_id, eval_id, prompt, grading (JSON text): of the run, else of the folder above it; the prompt else from a transcript."""
    runs = find_runs(spark, root)
    rel = _relative(spark, root)
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "{eval_metadata.json,grading.json,transcript.md}").text(root, wholetext=True).select(rel.alias("rel"), "value")
    files = files.select(F.coalesce(F.nullif(F.regexp_extract("rel", "^(.*)/[^/]*$", 1), F.lit("")), F.lit(".")).alias("dir"), F.element_at(F.split("rel", "/"), -1).alias("name"), "value")
    meta = F.from_json("value", schemas.METADATA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = files.filter("name = 'eval_metadata.json'").select("dir", meta.alias("m")).filter("m._corrupt_record is null").select("dir", F.nullif("m.prompt", F.lit("")).alias("prompt"), "m.eval_id")
    graded = files.filter("name = 'grading.json'").filter(F.try_parse_json("value").isNotNull() & ~F.trim("value").isin("", "{}", "null", "[]")).select("dir", F.col("value").alias("grading"))
    said = F.regexp_extract("value", r"## Eval Prompt\n\n([\s\S]*?)(?=\n##|\z)", 1)
    told = files.filter("name = 'transcript.md'").select("dir", F.nullif(F.regexp_replace(said, r"^\s+|\s+$", ""), F.lit("")).alias("said"))
    above = F.when(F.col("run_dir").contains("/"), F.regexp_extract("run_dir", "^(.*)/[^/]*$", 1)).when(F.col("run_dir") == ".", F.lit(None)).otherwise(".")
    outputs = F.when(F.col("run_dir") == ".", "outputs").otherwise(F.concat("run_dir", F.lit("/outputs")))
    x = runs.withColumns({"above": above, "outputs": outputs})
    for k, (key, part) in enumerate((("run_dir", parsed), ("above", parsed), ("run_dir", told), ("outputs", told), ("run_dir", graded), ("above", graded))):
        x = x.join(part.toDF(f"dir{k}", *[f"{c}{k}" for c in part.columns[1:]]), F.col(key) == F.col(f"dir{k}"), "left")
    own_id = F.when(F.col("prompt0").isNotNull(), F.col("eval_id0")).otherwise(F.coalesce("eval_id1", "eval_id0"))
    return x.select("run_id", F.coalesce(own_id, "eval_id0", "eval_id1").alias("eval_id"), F.coalesce("prompt0", "prompt1", "said2", "said3", F.lit("(No prompt found)")).alias("prompt"), F.coalesce("grading4", "grading5").alias("grading")).orderBy(F.asc_nulls_last("eval_id"), "run_id")


def run_id(path: Column) -> Column:
    return F.translate(path, "/\\", "--")


def embedded(path: Column, content: Column) -> list[Column]:
    """kind, mime and content of a file: text (bad bytes replaced), images and the like as data URI or base64."""
    ext = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    mime = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in MIME.items() for x in kv]), ext), F.lit("application/octet-stream"))
    raw = F.regexp_replace(F.base64(content), "[\r\n]", "")
    kind = F.when(ext.isin(*TEXT_TYPES), "text").when(ext.isin(*IMAGE_TYPES), "image").when(ext == "pdf", "pdf").when(ext == "xlsx", "xlsx").otherwise("other")
    data = F.when(kind == "text", F.make_valid_utf8(content.cast("string"))).when(kind == "xlsx", raw).otherwise(F.concat(F.lit("data:"), mime, F.lit(";base64,"), raw))
    return [kind.alias("kind"), mime.alias("mime"), data.alias("data")]


def front_matter(text: Column) -> dict[str, Column]:
    """name and description of a text's front matter, the last of repeated ones; empty where there is none.

    It lies between the first line and the next one that is `---`, white space aside. A folded or literal description is the indented
    lines after it, joined by spaces, up to the first line that isn't indented; quotes round a value go.
    """
    stripped = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    lines = F.split(text, "\n", -1)
    rest = F.slice(lines, F.lit(2), F.size(lines))
    end = F.array_position(F.transform(rest, lambda x: stripped(x) == "---"), True)
    has = F.coalesce((stripped(F.get(lines, F.lit(0))) == "---") & (end > 0), F.lit(False))
    head = F.when(has, F.slice(rest, F.lit(1), F.greatest(end - 1, F.lit(0)).cast("int"))).otherwise(F.array().cast("array<string>"))

    def last(key: str) -> tuple[Column, Column]:
        """Its place from 1, null if there is none, and its value."""
        place = F.array_max(F.filter(F.transform(head, lambda x, i: F.when(x.startswith(f"{key}:"), i + 1)), lambda i: i.isNotNull()))
        return place, F.coalesce(stripped(F.substr(F.get(head, place - 1), F.lit(len(key) + 2))), F.lit(""))

    unquoted = lambda c: F.regexp_replace(F.regexp_replace(c, '^"+|"+$', ""), "^'+|'+$", "")
    _, name = last("name")
    at, said = last("description")
    after = F.slice(head, F.coalesce(at, F.lit(0)) + 1, F.size(head) + 1)
    stop = F.array_position(F.transform(after, lambda x: ~(x.startswith("  ") | x.startswith("\t"))), True)
    block = F.when(stop > 0, F.slice(after, F.lit(1), (stop - 1).cast("int"))).otherwise(after)
    folded = F.array_join(F.transform(block, stripped), " ")
    return {"name": unquoted(name), "description": F.when(said.isin(">", "|", ">-", "|-"), folded).otherwise(unquoted(said)), "has_front_matter": has}


def events_of_lines(lines: DataFrame) -> DataFrame:
    """key, seq, e: event lines parsed, invalid ones left out. lines: key, seq, value."""
    return lines.withColumn("e", F.from_json("value", schemas.EVENT)).filter("e is not null and e.type is not null").drop("value")


def lines_of_chunks(chunks: DataFrame, block: int = 1024) -> DataFrame:
    """key, seq, value: the lines of byte streams that were cut anywhere. chunks: key, chunk (its number from 0, without gaps), bytes.

    A line's number is that of the line ends before it. Chunks go in blocks of `block` following ones: a line's pieces are put together
    within their block, and what is shuffled from there on are lines, by block and by number, not chunks. The line ends before a block are summed
    over one row a block, the only window over a whole key. What follows the last line end isn't a line yet. Blank lines are
    left out but keep their number, bytes that aren't UTF-8 are replaced, white space at the ends goes.
    Null bytes count as none; a key with several rows of one chunk number has no defined result.
    """
    # ISO-8859-1 has one character a byte, so that a character that was cut in two is whole again when its line is
    text = F.coalesce(F.decode("bytes", "ISO-8859-1"), F.lit(""))
    cut = chunks.select("key", F.floor(F.col("chunk") / block).alias("block"), "chunk", F.split(text, "\n", -1).alias("parts"))
    n = (F.size("parts") - 1).cast("long")
    before = F.sum(n).over(W.partitionBy("key", "block").orderBy("chunk")) - n
    pieces = cut.withColumn("first", before).select("key", "block", "chunk", "first", F.posexplode("parts").alias("i", "part"))
    sewn = lambda by: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, "part"))), lambda x: x["part"]), "").alias("part")
    lines = pieces.groupBy("key", "block", (F.col("first") + F.col("i")).alias("line")).agg(sewn("chunk"))
    of_key = W.partitionBy("key")
    blocks = cut.groupBy("key", "block").agg(F.sum(n).alias("n")).withColumns({"base": F.sum("n").over(of_key.orderBy("block")) - F.col("n"), "total": F.sum("n").over(of_key)})
    placed = lines.join(blocks.hint("merge").drop("n"), ["key", "block"]).withColumn("seq", F.col("base") + F.col("line")).filter("seq < total")
    whole = placed.groupBy("key", "seq").agg(sewn("block"))
    value = F.regexp_replace(F.make_valid_utf8(F.encode("part", "ISO-8859-1").cast("string")), r"^\s+|\s+$", "")
    return whole.select("key", "seq", value.alias("value")).filter("value <> ''")
