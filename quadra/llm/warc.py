"""WARC archives: writing with de-duplication, and reading with boundary-chain verification.

A record is ``WARC/1.0 CRLF headers CRLF CRLF block CRLF CRLF``. The Spark text writer makes such files as they
are: each row is a record without its final ``CRLF CRLF``, which is the line separator.

Reading. The magic can also stand inside a payload, so that a split of a file, seen alone, does not know which
magics start records. Spark's text reader cuts the file at *every* magic (line separator ``WARC/1.0 CRLF``); each
piece whose header has a length is a candidate with a successor offset. The candidates of one file form a forest
of pointers to the right, and the records are exactly those that the chain from the file's start reaches:

1. inside a block of a file (BLOCK_BYTES of its uncompressed bytes) each candidate's pointer is followed to the first
   offset outside the block, in one pass from the last candidate to the first;
2. between blocks, pointer jumping: in round k every entry knows the entry 2^k blocks further on, and the reached
   set doubles, so that a file of b blocks takes log2(b) small joins;
3. the reached entry of each block marks its own chain.

Magics inside payloads are never reached, also where the payload holds whole, well-formed records.

Compressed archives are read by one task each, so that they are written in files of about FILE_BYTES. Nulls, repeated rows
and empty tables: see :func:`write_warc`. A record may be as long as a row of text of Spark's reader (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.session import cut

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Copies of one payload are spread over so many keys when they look up the first of them.
SALTS = 16
#: Uncompressed bytes of a file that one group follows, and about so many bytes of payload to a file.
BLOCK_BYTES, FILE_BYTES = 4 << 20, 512 << 20


# ---------------------------------------------------------------- writing


def mark_revisits(pages: DataFrame, id_col: str, digest: str, length: str, least: int) -> DataFrame:
    """(id, digest, refers_to) of the rows that repeat the payload of a row with a smaller id.

    The first of each payload comes from an aggregation with map-side combine. Only payloads that occur more than
    once are looked up again, and the copies of one payload are salted over SALTS keys."""
    narrow = pages.select(F.col(id_col).alias("id"), F.col(digest).alias("digest"), F.col(length).alias("len"))
    narrow = narrow.where(F.col("len") >= least)
    firsts = narrow.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 and refers_to is not null").select(
        "digest", "refers_to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    salted = narrow.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS)))
    return (
        salted.join(firsts, ["digest", "salt"])
        .where(~F.col("id").eqNullSafe(F.col("refers_to")))
        .select("id", "digest", "refers_to")
        .distinct()
    )


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str | None = "url",
    payload_col: str = "html",
    least_revisit: int = 100,
    compression: str | None = "gzip",
    files: int | None = None,
) -> None:
    """Write a record for each row: ``response`` with the payload in UTF-8, or ``revisit`` without it.

    Of rows with equal payloads of at least ``least_revisit`` bytes, that with the smallest id is the response and
    the others refer to it; smaller payloads are all responses. A null payload is the empty one. Repeated rows
    (equal id and payload) get equal records; rows with a null id come last in that order and are written with an
    empty id. Other columns are ignored. An empty table makes an archive folder without records.
    ``files`` fixes the number of files; else the shuffle's partitions do, and a file that has had about FILE_BYTES of
    payloads is followed by another. Where the shuffle has fewer partitions than such files, rows are dealt out anew."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.col(url_col), F.lit("")) if url_col else F.lit("")).alias("url"),
        text.alias("payload"),
        F.octet_length(text).cast("long").alias("len"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
    )
    revisits = mark_revisits(rows, "id", "digest", "len", least_revisit)
    on = rows["id"].eqNullSafe(revisits["id"]) & (rows["digest"] == revisits["digest"])
    joined = rows.join(revisits, on, "left").select(rows["*"], revisits["refers_to"])
    count, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("len"), F.lit(0))).first()
    wanted = files or -(-size // FILE_BYTES)
    if files or wanted > int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        joined = joined.repartition(wanted)
    most = 0 if files else max(1, count * FILE_BYTES // max(size, 1))  # records; 0: no bound
    joined.select(_record()).write.option("lineSep", END).option("compression", compression or "none").option("maxRecordsPerFile", most).text(path)


def _record() -> Column:
    again = F.col("refers_to").isNotNull()
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        page(F.col("id")),
        F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: "), page(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nWARC-Target-URI: "),
        F.translate("url", "\r\n", "  "),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nWARC-Payload-Digest: sha256:"),
        F.col("digest"),
        F.lit("\r\nX-Payload-Length: "),
        F.col("len").cast("string"),
        F.lit("\r\nContent-Length: "),
        F.when(again, F.lit("0")).otherwise(F.col("len").cast("string")),
        F.lit(END),
    )
    return F.concat(head, F.when(again, "").otherwise(F.col("payload"))).alias("value")


# ---------------------------------------------------------------- reading


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """One row per piece between two magics: file, block, order in the block, bytes, header, length of the block.
    ``whole`` says that header, content and final CRLFs fill the piece exactly, or that it ends the file."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("raw"),
        F.octet_length("value").cast("long").alias("size"),
        F.substring_index("value", END, 1).alias("header"),
    )
    number = F.regexp_extract("header", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r\n|$)", 1)
    head = F.octet_length("header").cast("long") + len(END)
    rows = rows.withColumn("length", F.when((head <= F.col("size")) & (number != ""), number.try_cast("long")))
    rows = rows.withColumn("start", head)
    need = F.col("start") + F.col("length") + len(END)
    # The last record of a file is not followed by a magic: its bytes end with the file.
    return rows.withColumn("need", need).withColumn("whole", F.coalesce(F.col("size") >= need, F.lit(False)))


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``offset``: where the piece's header starts in the file, and sets ``block`` to its BLOCK_BYTES. Sums inside what
    each task read, then over these."""
    step = F.col("size") + len(MAGIC)
    inside = W.partitionBy("file", "block").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    blocks = rows.groupBy("file", "block").agg(F.sum(step).alias("total"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total")
    rows = rows.join(blocks, ["file", "block"]).withColumn("offset", F.col("base") + F.col("inside")).drop("base", "inside")
    return rows.withColumn("block", F.floor(F.col("offset") / BLOCK_BYTES))


def _exits(group):
    """Follow each candidate of a block to the first successor outside of the block's candidates."""
    group = group.sort_values("offset", ascending=False)
    known: dict[int, int] = {}
    for offset, succ in zip(group["offset"], group["succ"], strict=True):
        known[offset] = known.get(succ, succ)
    return group.assign(exit=[known[o] for o in group["offset"]])


def _marks(group):
    """Of a block's candidates keep those that its entries reach."""
    group = group.sort_values("offset")
    reached = set(group.loc[group["entry"], "offset"])
    keep = []
    for offset, succ in zip(group["offset"], group["succ"], strict=True):
        keep.append(offset in reached)
        if keep[-1]:
            reached.add(succ)
    return group.loc[keep, ["file", "offset"]]


def verify_chain(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from each file's start reaches.

    ``candidates``: file string, block long, offset long, succ long (the offset at which the next header would
    start). Null pointers and candidates that point nowhere end a chain. A group is a block of a file."""
    base = candidates.select("file", "block", "offset", "succ").where("succ is not null").distinct()
    hops = cut(
        base.groupBy("file", "block").applyInPandas(
            _exits, "file string, block long, offset long, succ long, exit long"
        )
    )
    root = F.lit(len(MAGIC)).cast("long")
    targets = hops.select("file", F.col("exit").alias("offset")).distinct()
    entries = hops.join(targets, ["file", "offset"], "left_semi").unionByName(hops.where(F.col("offset") == root)).distinct()
    jumps = cut(entries.select("file", "offset", F.col("exit").alias("jump"), (F.col("offset") == root).alias("reached")))
    count = jumps.where("reached").count()
    while True:
        far = jumps.select("file", F.col("offset").alias("jump"), F.col("jump").alias("far"))
        ahead = jumps.where("reached").select("file", F.col("jump").alias("offset")).distinct().withColumn("hit", F.lit(True))
        jumps = cut(
            jumps.join(far, ["file", "jump"], "left")
            .join(ahead, ["file", "offset"], "left")
            .select("file", "offset", F.col("far").alias("jump"), (F.col("reached") | F.coalesce("hit", F.lit(False))).alias("reached"))
        )
        now = jumps.where("reached").count()
        if now == count:
            break
        count = now
    starts = jumps.where("reached").select("file", "offset").withColumn("entry", F.lit(True))
    marked = hops.join(starts, ["file", "offset"], "left").select(
        "file", "block", "offset", "succ", F.coalesce("entry", F.lit(False)).alias("entry")
    )
    return marked.groupBy("file", "block").applyInPandas(_marks, "file string, offset long")


def read_warc(spark: SparkSession, path: str, fields: dict[str, Column] | None = None) -> DataFrame:
    """Read archives to one row per true record: file, offset, record_id, record_type, refers_to, url, digest,
    payload_length (of the full payload), and ``fields``: columns over ``payload`` (binary), by default the
    payload itself.

    The fields are computed while the pieces are scanned, so that only what the caller wants moves on: with a digest
    as field no payload is shuffled. Only records whose payload holds the magic are put together from their pieces,
    in a second scan that is left out where there is none. A folder without records gives no rows; so does a file
    whose start is no record."""
    fields = fields or {"payload": F.col("payload")}
    content = F.expr("substring(raw, cast(start + 1 as int), cast(length as int))")
    scan = _scan(spark, path)
    derived = scan.withColumn("payload", F.when(F.col("whole"), content))
    narrow = derived.select("file", "block", "at", "size", "header", "length", "need", "whole", *[v.alias(f"f_{k}") for k, v in fields.items()])
    rows = cut(_offsets(narrow)) if _small(fields) else _offsets(narrow)
    succ = F.col("offset") + F.col("need") + len(MAGIC)
    true = verify_chain(rows.where("length is not null").select("file", "block", "offset", succ.alias("succ")))
    records = rows.join(true, ["file", "offset"], "left_semi")
    broken = cut(records.where(~F.col("whole")).select("file", "offset", "header", "need"))
    found = records.where("whole").select("file", "offset", "header", *[f"f_{k}" for k in fields])
    if not broken.isEmpty():
        found = found.unionByName(_reassemble(scan, broken, fields))
    return found.select("file", "offset", *_header_columns(), *[F.col(f"f_{k}").alias(k) for k in fields])


def _small(fields: dict[str, Column]) -> bool:
    return "payload" not in fields


def _reassemble(scan: DataFrame, broken: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Records whose payload was cut at a magic. Pieces meet the records in the blocks that these span, so that only pieces
    of such records move."""
    parts = _offsets(scan.select("file", "block", "at", "size", "raw").join(broken.select("file").distinct(), "file", "left_semi"))
    blocks = F.sequence(F.floor(F.col("offset") / BLOCK_BYTES), F.floor((F.col("offset") + F.col("need")) / BLOCK_BYTES))
    spans = broken.select("file", F.col("offset").alias("own"), "need", F.explode(blocks).alias("block"))
    owned = parts.join(spans, ["file", "block"]).where((F.col("offset") >= F.col("own")) & (F.col("offset") < F.col("own") + F.col("need")))
    joined = owned.groupBy("file", "own").agg(F.array_sort(F.collect_list(F.struct("offset", "raw"))).alias("parts"))
    joined = joined.join(broken.select("file", F.col("offset").alias("own"), "header"), ["file", "own"])
    glue = F.lit(MAGIC).cast("binary")
    data = F.aggregate("parts", F.lit(None).cast("binary"), lambda acc, x: F.when(acc.isNull(), x["raw"]).otherwise(F.concat(acc, glue, x["raw"])))
    number = F.regexp_extract("header", r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r\n|$)", 1).cast("int")
    payload = F.substring(data, F.octet_length("header") + len(END) + 1, number)
    joined = joined.select("file", F.col("own").alias("offset"), "header", payload.alias("payload"))
    return joined.select("file", "offset", "header", *[v.alias(f"f_{k}") for k, v in fields.items()])


def _header_columns() -> list[Column]:
    def value(name: str, then: str = "(.*?)") -> Column:
        return F.regexp_extract("header", rf"(?is)(?:^|\r\n){name}:[ \t]*{then}[ \t]*(?:\r\n|$)", 1)

    blank = lambda c: F.when(c != "", c)
    return [
        blank(value("WARC-Record-ID", "<(.*?)>")).alias("record_id"),
        blank(value("WARC-Type")).alias("record_type"),
        blank(value("WARC-Refers-To", "<(.*?)>")).alias("refers_to"),
        value("WARC-Target-URI").alias("url"),
        blank(value("WARC-Payload-Digest", "sha256:(.*?)")).alias("digest"),
        blank(value("X-Payload-Length")).cast("long").alias("payload_length"),
    ]
