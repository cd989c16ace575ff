"""WARC archives: writing with revisit records, and reading in parallel by boundary-chain verification.

Reading cuts an archive at every occurrence of the version line, wherever it is. Each task thereby emits candidates: the
offset of an occurrence and, if header fields with a length follow, the offset of its successor. Only candidates that are
reached from the start of their file are records; pointer jumping finds them, after runs of candidates that follow each
other in one split have been made one step. An occurrence inside a payload is never reached, and is put back into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keyed import lookup_join
from ..session import materialize

VERSION = "WARC/1.1\r\n"
# Payloads of fewer bytes are always written in full.
MIN_REVISIT_BYTES = 1000
_END = "\r\n\r\n"
_URN = "<urn:page:"


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))


def _urn(key: Column) -> Column:
    return F.concat(F.lit(_URN), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write one record per row as ``*.txt`` archives below ``path``, a new folder that all executors reach.

    Of rows with equal payloads of at least ``min_bytes`` bytes, that with the largest key is a ``response``; the others
    are ``revisit`` records without the payload that refer to it. Rows that tie for the largest key are all responses. A null
    payload is empty, a null key is written as an empty name, a null url as an empty one. Line
    ends in a url are percent-encoded, since they would end its header line. An empty table gives a folder without records.
    """
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.replace(F.replace(F.coalesce(F.col(url).cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    )
    same = F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256))
    copies = rows.select(same.alias("_same"), "page_id").where("_same is not null").groupBy("_same").agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_to"))
    copies = materialize(copies.where("_n > 1"))
    marked = lookup_join(rows.withColumn("_same", same), copies, "_same", weight="_n")
    revisit = F.col("_n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_to"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _line("Content-Length", F.octet_length("payload").cast("string")), F.lit("\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    reference = F.when(revisit, F.concat(_line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), _line("WARC-Refers-To", _urn(F.col("_to"))))).otherwise(F.lit(""))
    record = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", F.col("url")),
        reference,
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        _line("Content-Type", "application/http; msgtype=response"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    marked.select(record.alias("value")).write.option("lineSep", _END).text(path)


def _candidates(spark: SparkSession, path: str, version: str) -> DataFrame:
    """One row per occurrence of ``version``, in any payload too.

    ``file, block`` (the split), ``offset, successor`` (null if no header with a length follows), ``file_size``, header
    fields, ``whole`` (the record lies in this cut), ``payload_sha1`` (if whole), ``cut`` (hash of the text up to the next one).
    """
    v, mark, end = F.col("value"), len(version), len(_END)
    header = F.substring_index(v, _END, 1)
    field = lambda name: F.regexp_extract("header", rf"(?i)(?:\A|\r\n){name}[ \t]*:[ \t]*([^\r\n]*)", 1)
    cuts = spark.read.option("lineSep", version).text(path)
    cuts = cuts.select(
        v, header.alias("header"), F.octet_length(header).cast("bigint").alias("h"), F.octet_length(F.substring_index(v, _END, 2)).cast("bigint").alias("h2"), F.octet_length(v).cast("bigint").alias("size"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("file_size"), F.monotonically_increasing_id().alias("seq"),
    )
    length = F.when(F.contains(v, F.lit(_END)), field("Content-Length").try_cast("bigint"))
    length = F.when(length >= 0, length)
    inner = field("Content-Type").ilike("application/http%")
    cuts = cuts.select(
        "*", length.alias("length"), field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("uri"), field("WARC-Refers-To").alias("refers_to"),
        F.when(inner & (F.col("h2") <= F.col("h") + length), F.col("h2") - F.col("h")).otherwise(0).alias("skip"),
    )
    whole = F.coalesce(F.col("size") >= F.col("h") + end + F.col("length") + end, F.lit(False))
    found = materialize(
        cuts.select(
            "file", "block", "seq", "file_size", "size", "h", "length", "skip", "record_type", "record_id", "uri", "refers_to", whole.alias("whole"),
            F.when(whole, F.sha1(_payload(v, F.col("h"), F.col("skip"), F.col("length")))).alias("payload_sha1"), F.md5(v).alias("cut"),
        )
    )
    ordered = Window.partitionBy("file", "block").orderBy("seq")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    sizes = found.groupBy("file", "block").agg(F.sum(F.col("size") + mark).alias("_size"))
    base = sizes.select("file", "block", F.coalesce(F.sum("_size").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    placed = found.withColumn("_local", F.coalesce(F.sum(F.col("size") + mark).over(before), F.lit(0))).join(base, ["file", "block"])
    # what stands before the first occurrence in a file is no candidate
    placed = placed.withColumn("offset", F.col("_base") + F.col("_local") - mark).where("offset >= 0").drop("_base", "_local")
    placed = placed.withColumn("successor", F.col("offset") + mark + F.col("h") + end + F.col("length") + end)
    opens = F.coalesce((F.lag("successor").over(ordered) != F.col("offset")).cast("int"), F.lit(1))
    runs = placed.withColumn("run", F.sum(opens).over(ordered))
    # only the last of a run can be without a successor; then the run leads nowhere
    run = Window.partitionBy("file", "block", "run")
    return materialize(runs.withColumn("jump", F.when(F.count("successor").over(run) == F.count("offset").over(run), F.max("successor").over(run))))


def _payload(cut: Column, h: Column, skip: Column, length: Column) -> Column:
    """Bytes of the payload in ``cut``, which begins with the header of a record: its block without an HTTP header."""
    return F.substring(cut.cast("binary"), (h + len(_END) + skip + 1).cast("int"), (length - skip).cast("int"))


def _reached(candidates: DataFrame) -> DataFrame:
    """``file, block, run, first``: in each run with records, the smallest offset that the chain of its file reaches."""
    entries = candidates.select("file", F.col("jump").alias("offset")).where("offset is not null").unionByName(candidates.select("file", F.lit(0).cast("bigint").alias("offset"))).distinct()
    nodes = materialize(candidates.join(entries, ["file", "offset"], "left_semi").select("file", F.col("offset").alias("at"), F.col("jump").alias("to"), "block", "run"))
    pointers = nodes.select("file", "at", "to").where("to is not null")
    reached = materialize(nodes.where("at = 0").select("file", "at"))
    seen = reached.count()
    while True:
        # those reached are the first 2**k of a chain; pointers go 2**k steps, so the next ones are new
        step = reached.join(pointers, ["file", "at"]).select("file", F.col("to").alias("at"))
        step = step.join(nodes.select("file", "at"), ["file", "at"], "left_semi")
        reached = materialize(reached.unionByName(step))
        now = reached.count()
        if now == seen:
            return nodes.join(reached, ["file", "at"], "left_semi").groupBy("file", "block", "run").agg(F.min("at").alias("first"))
        seen = now
        pointers = materialize(pointers.join(pointers.select("file", F.col("at").alias("to"), F.col("to").alias("_to")), ["file", "to"]).select("file", "at", F.col("_to").alias("to")))


def read(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """The records of all archives below ``path``: ``file, offset, record_type, record_id, uri, refers_to, payload_bytes, payload_sha1``.

    A file that does not start with a record has none, a chain that ends early (a damaged length) ends the file, and a
    record that is cut off at the end of the file is left out. Fields that a header lacks are empty. Payload figures are
    those of the bytes in the archive, so for a revisit they are 0 and the digest of nothing.
    """
    candidates = _candidates(spark, path, version)
    placed = candidates.join(materialize(_reached(candidates)), ["file", "block", "run"], "left")
    record = F.coalesce(F.col("offset") >= F.col("first"), F.lit(False)) & F.coalesce(F.col("successor") <= F.col("file_size"), F.lit(False))
    placed = materialize(placed.withColumn("record", record).drop("first", "jump", "run"))
    records = placed.where("record")
    names = ["file", "offset", "record_type", "record_id", "uri", "refers_to", (F.col("length") - F.col("skip")).alias("payload_bytes"), "payload_sha1"]
    split = records.where("not whole")
    if split.isEmpty():
        return records.select(*names)
    # payloads with the version line inside: the cuts of each, told by their content, are joined again
    ordered = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = placed.groupBy("file", "block").agg(F.max(F.when(F.col("record"), F.col("offset"))).alias("_last"))
    carried = last.select("file", "block", F.max("_last").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    owned = placed.withColumn("_own", F.max(F.when(F.col("record"), F.col("offset"))).over(ordered)).join(carried, ["file", "block"])
    owned = owned.select("file", "offset", "cut", F.coalesce("_own", "_carried").alias("owner"))
    parts = materialize(owned.join(split.select("file", F.col("offset").alias("owner")), ["file", "owner"], "left_semi"))
    values = spark.read.option("lineSep", version).text(path).select("value", F.md5("value").alias("cut"))
    values = values.join(parts.select("cut").distinct(), "cut", "left_semi").groupBy("cut").agg(F.first("value").alias("value"))
    texts = parts.join(values, "cut").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("offset", "value"))).alias("_cuts"))
    joined = split.drop("payload_sha1").join(texts.withColumnRenamed("owner", "offset"), ["file", "offset"])
    joined = joined.withColumn("_text", F.array_join(F.transform("_cuts", lambda c: c["value"]), version))
    joined = joined.withColumn("payload_sha1", F.sha1(_payload(F.col("_text"), F.col("h"), F.col("skip"), F.col("length"))))
    return records.where("whole").select(*names).unionByName(joined.select(*names))


def digest(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of records that ``write`` wrote.

    A revisit has the figures of the payload it refers to, read from the archive; null if no such response is there.
    """
    page = lambda c: F.regexp_extract(c, rf"\A{_URN}(-?\d*)>", 1).try_cast("bigint")
    full = records.where("record_type <> 'revisit'")
    revisits = records.where("record_type = 'revisit'")
    wanted = revisits.groupBy("refers_to").agg(F.count(F.lit(1)).alias("_n"))
    targets = full.select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_sha1").alias("_sha1")).join(wanted, "refers_to").dropDuplicates(["refers_to"])
    followed = lookup_join(revisits, materialize(targets), "refers_to", weight="_n")
    return full.select(page("record_id").alias("page_id"), "payload_bytes", F.col("payload_sha1").alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        followed.select(page("record_id").alias("page_id"), F.col("_bytes").alias("payload_bytes"), F.col("_sha1").alias("payload_digest"), "record_type", page("refers_to").alias("refers_to"))
    )
