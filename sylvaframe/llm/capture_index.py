"""WARC capture index: sorted runs merged by a loser tree into global order.

Each input partition writes one run of index records, a file sorted by URL key,
timestamp and page id. Runs are then merged externally: a task opens up to
FAN_IN runs at once, reads them batch by batch and merges them with a loser
tree, so each record costs log2(k) comparisons and a task holds one row group a
run, whatever the runs' sizes. A merge of many records is cut into ranges of the
key, one task each; row-group statistics tell a task where its range begins in
each run. More than FAN_IN runs take several rounds. The last round's ranges in
order are the whole index: every URL's capture history in time order. Positions
across ranges come from a table with one row per range.

The URL key is the host's labels reversed, then the path and query: scheme,
user, default port, a leading www, the fragment, empty and tracking parameters
are left out. ``pages`` has no capture time, so one is derived from page_id.
``read_cdx`` takes records with their own times from the text lines of an index.

Defined results: a null url has an empty key and comes first; a null html has a
null digest and 0 bytes; a null page_id counts as 0 for the time and comes
first among equals. Repeated rows are all kept, one after another. A very long
url or page is indexed as any other. An empty table gives no rows. Columns other
than page_id, url and html are left out.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import pick, scratch_path, small_side

ROWS_PER_RANGE = 500_000
FAN_IN = 64
#: Rows of a row group; what a task holds of each run it merges.
GROUP_ROWS = 4_096
#: Keys drawn for each range to cut, and at most in all.
DRAWN_PER_RANGE, MAX_DRAWN = 32, 200_000
EPOCH, SPAN, STEP = 1_704_067_200, 31_536_000, 7919


def url_key(url: Column) -> Column:
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(F.regexp_replace(rest, r"#[\s\S]*$", ""), r"^[^/?@]*@", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?:]*)", 1)), r"^www[0-9]*\.", "")
    port = F.regexp_replace(F.regexp_extract(rest, r"^[^/?:]*(:[0-9]+)", 1), r"^:(80|443)$", "")
    tail = F.regexp_extract(rest, r"^[^/?]*([/?][\s\S]*)$", 1)
    path = F.regexp_extract(tail, r"^([^?]*)", 1)
    # each parameter with the sign before it goes if it is empty or tracks
    query = F.regexp_replace(F.concat(F.lit("&"), F.regexp_extract(tail, r"\?([\s\S]*)$", 1)), r"&(?:(?:ref|utm_[a-z]+)=[^&]*)?(?=&|$)", "")
    query = F.regexp_replace(query, "^&", "?")
    path = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path, query)
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("")).otherwise(key)


def capture_time(page_id: Column) -> Column:
    seconds = F.lit(EPOCH) + F.pmod(F.coalesce(page_id, F.lit(0)) * F.lit(STEP), F.lit(SPAN))
    return F.date_format(F.timestamp_seconds(seconds), "yyyyMMddHHmmss")


class _Feed:
    """A list, or a RunReader that is refilled, as a run of the tree."""

    def __init__(self, run):
        self.run = run
        self.at = 0

    def head(self):
        run = self.run
        if isinstance(run, list):
            return run[self.at] if self.at < len(run) else None
        if run.at >= len(run.keys) and run.rows is not None:
            run.next_batch()
        return run.keys[run.at] if run.at < len(run.keys) else None

    def place(self):
        return self.at if isinstance(self.run, list) else self.run.at

    def step(self):
        if isinstance(self.run, list):
            self.at += 1
        else:
            self.run.at += 1
        return self.head()


class LoserTree:
    """Merges k sorted runs; each pop replays one leaf-to-root path.

    ``loser[i]`` holds the run that lost the match at inner node i, ``loser[0]``
    the winner. An exhausted run has the key None, which loses to any other.
    Equal keys go to the lower run.
    """

    def __init__(self, runs: list):
        self.feeds = [r if isinstance(r, _Feed) else _Feed(r) for r in runs] or [_Feed([])]
        self.k = len(self.feeds)
        self.head_of = [f.head() for f in self.feeds]
        winners = [0] * self.k + list(range(self.k))
        self.loser = [0] * self.k
        for i in range(self.k - 1, 0, -1):
            a, b = winners[2 * i], winners[2 * i + 1]
            winners[i], self.loser[i] = (a, b) if self._beats(a, b) else (b, a)
        self.loser[0] = winners[1] if self.k > 1 else 0

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.head_of[a], self.head_of[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or (x == y and a < b)

    def _winners(self) -> Iterator[int]:
        while self.head_of[w := self.loser[0]] is not None:
            yield w
            self.head_of[w] = self.feeds[w].step()
            i = (w + self.k) // 2
            while i:
                if self._beats(self.loser[i], w):
                    self.loser[i], w = w, self.loser[i]
                i //= 2
            self.loser[0] = w

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position in it) in merged order."""
        for w in self._winners():
            yield w, self.feeds[w].place()

    def records(self) -> Iterator[tuple[int, tuple, pa.Table, int]]:
        """(run, key, the batch it lies in, its place there) for runs that are read from files."""
        for w in self._winners():
            run = self.feeds[w].run
            yield w, self.head_of[w], run.rows, run.at


_FIELDS = "url_key string, ts string, page_id long, url string, digest string, n_bytes long"
_ORDER = ("url_key", "ts", "page_id")
_MERGED = f"range_no int, at long, in_key long, {_FIELDS}"


def records_of(pages: DataFrame) -> DataFrame:
    """Index records of raw pages."""
    return pick(pages, "page_id", "url", "html").select(
        url_key(F.col("url")).alias("url_key"),
        capture_time(F.col("page_id")).alias("ts"),
        "page_id",
        "url",
        F.sha1(F.col("html").cast("binary")).alias("digest"),
        F.coalesce(F.octet_length("html"), F.lit(0)).cast("long").alias("n_bytes"),
    )


def read_cdx(spark: SparkSession, path: str) -> DataFrame:
    """Index records from lines ``key timestamp url mime status digest ... length offset file``; other lines are left out.

    The key is made from the url, so that it is of the same form everywhere. There is no page id.
    """
    f = F.split(F.trim("value"), " +")
    lines = spark.read.text(path).where(F.regexp_like("value", F.lit(r"^\S+ [0-9]{14} \S+ "))).select(f.alias("f"))
    size = F.try_element_at("f", F.lit(-3)).try_cast("long")
    return lines.select(
        url_key(F.get("f", F.lit(2))).alias("url_key"), F.get("f", F.lit(1)).alias("ts"), F.lit(None).cast("long").alias("page_id"), F.get("f", F.lit(2)).alias("url"),
        F.lower(F.get("f", F.lit(5))).alias("digest"), F.coalesce(size, F.lit(0)).alias("n_bytes"),
    )


def write_runs(records: DataFrame) -> DataFrame:
    """(run, file, rows): each partition's records as one sorted file, which is a run."""
    spark = records.sparkSession
    path = scratch_path(spark, "runs")
    records.sortWithinPartitions(*_ORDER).write.option("parquet.block.row.count.limit", GROUP_ROWS).parquet(path)
    return _listed(spark.read.schema(_FIELDS).parquet(path), F.lit(0))


def _listed(rows: DataFrame, range_no: Column) -> DataFrame:
    """(run, file, part, rows): the files that are there, a run each; ``part``: the file's place within its run."""
    files = rows.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    return files.select(F.col("file").alias("run"), "file", range_no.cast("int").alias("part"), "rows")


def key_of(url_key: str, ts: str, page_id: int | None) -> tuple:
    """In the order in which Spark sorts: strings by their bytes, null ids first."""
    return url_key.encode(), ts, -(2**63) if page_id is None else page_id


class RunReader:
    """A run's records from ``low`` (inclusive) to ``high`` (exclusive), row group by row group."""

    def __init__(self, files: list[str], low: tuple | None, high: tuple | None):
        self.batches = self._read(files, low, high)
        self.keys: list[tuple] = []
        self.rows: pa.Table | None = None
        self.at = 0
        self.next_batch()

    def _read(self, files: list[str], low: tuple | None, high: tuple | None) -> Iterator[tuple[pa.Table, list[tuple]]]:
        from pyarrow import fs, parquet

        for uri in files:
            system, name = fs.FileSystem.from_uri(uri)
            with system.open_input_file(name) as source:
                file = parquet.ParquetFile(source)
                column = file.schema_arrow.names.index("url_key")  # flat schemas only, so columns and leaves agree
                for g in range(file.num_row_groups):
                    stats = file.metadata.row_group(g).column(column).statistics
                    if stats is not None and stats.has_min_max:
                        if low is not None and _bytes(stats.max) < low[0]:
                            continue
                        if high is not None and _bytes(stats.min) > high[0]:
                            return
                    rows = file.read_row_group(g)
                    keys = list(map(key_of, *[rows[c].to_pylist() for c in _ORDER]))
                    a = 0 if low is None else bisect_left(keys, low)
                    b = len(keys) if high is None else bisect_left(keys, high)
                    if a < b:
                        yield rows.slice(a, b - a), keys[a:b]
                    if b < len(keys):
                        return

    def next_batch(self) -> None:
        self.rows, self.keys = next(self.batches, (None, []))
        self.at = 0


def _bytes(value) -> bytes:
    return value.encode() if isinstance(value, str) else bytes(value)


def merge_streams(runs: list[RunReader], chunk: int = 8_192) -> Iterator[tuple[pa.Table, list[tuple]]]:
    """The runs' records in order, in chunks. A run is refilled when the tree has used up its batch."""
    tree = LoserTree([_Feed(r) for r in runs])
    keys: list[tuple] = []
    taken: list[tuple[int, int]] = []
    held: list[pa.Table] = []
    ids: dict[int, int] = {}
    base: list[int] = []
    size = 0
    for run, key, rows, at in tree.records():
        place = ids.get(id(rows))
        if place is None:
            place = ids[id(rows)] = len(held)
            held.append(rows)
            base.append(size)
            size += rows.num_rows
        taken.append(base[place] + at)
        keys.append(key)
        if len(taken) >= chunk:
            yield pa.concat_tables(held).take(pa.array(taken)), keys
            keys, taken, held, ids, base, size = [], [], [], {}, [], 0
    if taken:
        yield pa.concat_tables(held).take(pa.array(taken)), keys


_TASK = "merge int, range_no int, files array<struct<run:string,part:int,file:string>>, low struct<url_key:string,ts:string,page_id:long>, high struct<url_key:string,ts:string,page_id:long>"


def _open(task: dict) -> list[RunReader]:
    bound = lambda k: None if k is None else key_of(k["url_key"], k["ts"], k["page_id"])
    by_run: dict[str, list] = {}
    for f in sorted(task["files"], key=lambda f: (f["run"], f["part"])):
        by_run.setdefault(f["run"], []).append(f["file"])
    return [RunReader(files, bound(task["low"]), bound(task["high"])) for files in by_run.values()]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row is a merge's range; gives its records in order with their place and their place among their key's."""
    for batch in batches:
        for task in batch.to_pylist():
            at, last, in_key = 0, None, 0
            for rows, keys in merge_streams(_open(task)):
                seq = []
                for key in keys:
                    in_key = in_key + 1 if key[0] == last else 1
                    last = key[0]
                    seq.append(in_key)
                n = rows.num_rows
                columns = [pa.array([task["range_no"]] * n, pa.int32()), pa.array(range(at + 1, at + n + 1), pa.int64()), pa.array(seq, pa.int64())]
                at += n
                fields = [("url_key", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("n_bytes", pa.int64())]
                columns += [rows[name].combine_chunks().cast(kind) for name, kind in fields]
                yield from pa.table(columns, names=["range_no", "at", "in_key", *[f for f, _ in fields]]).combine_chunks().to_batches()


def cuts_of(spark: SparkSession, files: list[str], ranges: int) -> list[tuple | None]:
    """Bounds of that many ranges of like size, from keys drawn by a hash; only the balance depends on the draw."""
    if ranges < 2:
        return [None, None]
    rows = spark.read.schema(_FIELDS).parquet(*files)
    total = rows.count()
    every = max(1, total // min(MAX_DRAWN, ranges * DRAWN_PER_RANGE))
    drawn = rows.where(F.pmod(F.xxhash64(*_ORDER, "url"), F.lit(every)) == 0).select(*_ORDER).collect()
    keys = sorted({key_of(*r): tuple(r) for r in drawn}.items())
    picked = [keys[len(keys) * k // ranges][1] for k in range(1, ranges)] if keys else []
    return [None, *dict.fromkeys(picked), None]


def merge_round(spark: SparkSession, runs: list[tuple], rows_per_range: int, fan_in: int) -> tuple[DataFrame, bool]:
    """One round over (run, file, part, rows) lines: merged records, written, and whether that was the last round."""
    names = sorted({r["run"] for r in runs})
    groups = [names[i : i + fan_in] for i in range(0, len(names), fan_in)] or [[]]
    tasks = []
    for g, members in enumerate(groups):
        mine = [r for r in runs if r["run"] in set(members)]
        rows = sum(r["rows"] for r in mine)
        bounds = cuts_of(spark, [r["file"] for r in mine], -(-rows // rows_per_range)) if mine else [None, None]
        listed = [(r["run"], r["part"], r["file"]) for r in mine]
        tasks += [(g, k, listed, low, high) for k, (low, high) in enumerate(zip(bounds, bounds[1:]))]
    # one task each: their number is that of ranges, which is bounded by rows / rows_per_range and runs / fan_in
    table = spark.createDataFrame(tasks, _TASK).withColumn("slot", F.monotonically_increasing_id()).repartition(max(1, len(tasks)), "slot").drop("slot")
    path = scratch_path(spark, "merged")
    merged = table.mapInArrow(_merge, _MERGED) if len(groups) == 1 else table.mapInArrow(_with_group, f"merge int, {_MERGED}")
    out = merged.write.option("parquet.block.row.count.limit", GROUP_ROWS)
    (out if len(groups) == 1 else out.partitionBy("merge", "range_no")).parquet(path)
    return spark.read.schema(merged.schema).parquet(path), len(groups) == 1


def _with_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, merge in enumerate(batch.column(0).to_pylist()):
            for out in _merge(iter([batch.slice(k, 1)])):
                yield pa.RecordBatch.from_arrays([pa.array([merge] * len(out), pa.int32()), *out.columns], ["merge", *out.schema.names])


def capture_runs(pages: DataFrame) -> DataFrame:
    """(run, file, part, rows) of the sorted runs of pages."""
    return write_runs(records_of(pages))


def merge_runs(runs: DataFrame, rows_per_range: int = ROWS_PER_RANGE, fan_in: int = FAN_IN) -> DataFrame:
    """The whole index in order: pos is a record's place in it, seq in its URL's history."""
    spark = runs.sparkSession
    listed = runs.collect()  # one line a file
    while True:
        merged, last = merge_round(spark, listed, rows_per_range, fan_in)
        if last:
            break
        files = merged.select("merge", "range_no", F.col("_metadata.file_path").alias("file")).groupBy("merge", "range_no", "file").agg(F.count(F.lit(1)).alias("rows"))
        listed = files.select(F.format_string("%08d", "merge").alias("run"), "file", F.col("range_no").alias("part"), "rows").collect()
    ranges = max(1, merged.select("range_no").distinct().count())
    # two rows a range: its first and its last key, all that can go on in the next one
    ends = merged.groupBy("range_no").agg(
        F.max("at").alias("rows"), F.min_by("url_key", "at").alias("first_key"), F.max_by("url_key", "at").alias("last_key"), F.max_by("in_key", "at").alias("last_rows")
    )
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("pos_before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    same = Window.partitionBy("last_key").orderBy("range_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tails = ends.select(F.col("last_key").alias("t_key"), F.col("range_no").alias("t_no"), F.sum("last_rows").over(same).alias("upto"))
    heads = ends.join(tails, (F.col("first_key") == F.col("t_key")) & (F.col("t_no") < F.col("range_no")), "left")
    heads = heads.groupBy("range_no", "first_key", "pos_before").agg(F.coalesce(F.max("upto"), F.lit(0)).alias("seq_before"))
    joined = merged.join(small_side(heads, ranges, 256), "range_no")
    seq = F.col("in_key") + F.when(F.col("url_key") == F.col("first_key"), F.col("seq_before")).otherwise(0)
    return joined.select(
        (F.col("pos_before") + F.col("at")).alias("pos"), "url_key", "ts", seq.alias("seq"), "page_id", "url", "digest", "n_bytes"
    )


def capture_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_runs(capture_runs(spark.read.parquet(f"{sf_dir}/pages.parquet")))


CAPTURE_SQL = rf"""
WITH a AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#[\s\S]*$', ''), '^[^/?@]*@', '') AS rest FROM pages
), b AS (
  SELECT *, regexp_replace(lower(regexp_extract(rest, '^([^/?:]*)', 1)), '^www[0-9]*\.', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?:]*(:[0-9]+)', 1), '^:(80|443)$', '') AS port,
    regexp_extract(rest, '^[^/?]*([/?][\s\S]*)$', 1) AS tail FROM a
), q AS (
  SELECT *, string_split(tail, '?')[1] AS path,
    list_filter(string_split(substr(tail, strpos(tail || '?', '?') + 1), '&'), lambda x: x <> '' AND NOT (starts_with(x, 'ref=') OR (starts_with(x, 'utm_') AND regexp_matches(x, '^utm_[a-z]+=')))) AS params FROM b
), c AS (
  SELECT page_id, url,
    CASE WHEN coalesce(url, '') = '' THEN ''
      ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || port || ')' || CASE WHEN starts_with(path, '/') THEN path ELSE '/' || path END
        || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS url_key,
    strftime(make_timestamp(({EPOCH} + ((coalesce(page_id, 0) * {STEP}) % {SPAN} + {SPAN}) % {SPAN}) * 1000000), '%Y%m%d%H%M%S') AS ts,
    sha1(html) AS digest, coalesce(octet_length(encode(html)), 0)::BIGINT AS n_bytes FROM q
)
SELECT row_number() OVER (ORDER BY url_key, ts, page_id NULLS FIRST) AS pos, url_key, ts,
  row_number() OVER (PARTITION BY url_key ORDER BY ts, page_id NULLS FIRST) AS seq, page_id, url, digest, n_bytes FROM c
"""
