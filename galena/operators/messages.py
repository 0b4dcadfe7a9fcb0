"""Messages delivered more than once: an index of identifiers that keeps one copy of each."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galena.session import new_path, read_text, remove_path, write_text

_CANDIDATE = "id string, h long, ts long, ingest_date string, part int, off long"
_ARRAYS = "kind string, prefix int, seq int, ids array<string>, hs array<long>, ts array<long>, ingest array<string>, part array<int>, off array<long>"
_ORDER = ["h", "id", "ts", "ingest_date", "part", "off"]
_ASC = [True, True, False, True, True, True]
#: One array of a run has at most about so many identifiers where it is read from or written to a row.
_PIECE = 50_000


def message_id(own: Column, payload: Column, field: str = "id") -> Column:
    """The identifier of a message: own, or where that is null the payload's field; without white space around it and
    in lower case. Null where there is neither (an unreadable payload has none)."""
    return F.lower(F.regexp_replace(F.coalesce(own, F.from_json(payload, "map<string,string>")[field]), r"(?U)^\s+|\s+$", ""))


def _first_of_each(b: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """Sorted by hash, identifier and the order of preference; and whether a row is its identifier's first."""
    b = b.sort_values(_ORDER, ascending=_ASC, kind="stable", na_position="last").reset_index(drop=True)
    first = np.ones(len(b), bool)
    first[1:] = (b["h"].to_numpy()[1:] != b["h"].to_numpy()[:-1]) | (b["id"].to_numpy()[1:] != b["id"].to_numpy()[:-1])
    return b, first


def _pieces(kind: str, prefix: int, seq: int, b: pd.DataFrame) -> Iterator[dict]:
    for a in range(0, len(b), _PIECE):
        x = b.iloc[a : a + _PIECE]
        known = kind == "run"
        yield {"kind": kind, "prefix": prefix, "seq": seq, "ids": x["id"].tolist() if known else [], "hs": x["h"].to_numpy() if known else np.zeros(0, np.int64), "ts": x["ts"].to_numpy() if known else np.zeros(0, np.int64), "ingest": x["ingest_date"].tolist(), "part": x["part"].to_numpy(), "off": x["off"].to_numpy()}


def _table(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "prefix", "seq", "ids", "hs", "ts", "ingest", "part", "off"])


def _run(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one run as a frame sorted by (hash, identifier)."""
    rows = rows.iloc[np.argsort([x[0] for x in rows["hs"]], kind="stable")]
    col = lambda c: np.concatenate([np.asarray(x) for x in rows[c]])
    b = pd.DataFrame({"id": col("ids"), "h": col("hs"), "ts": col("ts"), "ingest_date": col("ingest"), "part": col("part"), "off": col("off")})
    return b.sort_values(["h", "id"], kind="stable").reset_index(drop=True) if len(rows) > 1 else b


def _locate(run: pd.DataFrame, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The position of each identifier in a sorted run by binary search on the hash, -1 where it isn't there. The
    identifier itself decides; equal hashes of different identifiers are stepped over."""
    keys, names = run["h"].to_numpy(), run["id"].to_numpy()
    at = np.searchsorted(keys, h)
    found = np.full(len(h), -1)
    rest = np.flatnonzero(at < len(keys))
    while len(rest):
        rest = rest[keys[at[rest]] == h[rest]]
        same = names[at[rest]] == ids[rest]
        found[rest[same]] = at[rest[same]]
        rest = rest[~same]
        at[rest] += 1
        rest = rest[at[rest] < len(keys)]
    return found


def _settle(prefix: int, index: pd.DataFrame, batch: pd.DataFrame, seq: int) -> list[dict]:
    """One prefix: the surplus rows that a batch brings or makes, and the run of its new or better copies."""
    b, first = _first_of_each(batch)
    surplus, best = [b[~first]], b[first].reset_index(drop=True)
    h, ids = best["h"].to_numpy(), best["id"].to_numpy()
    keep, rest = np.ones(len(best), bool), np.arange(len(best))
    for s in sorted(index["seq"].unique(), reverse=True):  # the newest run that holds an identifier has its truth
        if not len(rest):
            break
        run = _run(index[index["seq"] == s])
        at = _locate(run, h[rest], ids[rest])
        new, old, hit = best.iloc[rest[at >= 0]], run.iloc[at[at >= 0]], rest[at >= 0]
        n = [new[c].to_numpy() for c in ("ts", "ingest_date", "part", "off")]
        o = [old[c].to_numpy() for c in ("ts", "ingest_date", "part", "off")]
        better, tie = n[0] > o[0], n[0] == o[0]
        for x, y in zip(n[1:], o[1:]):
            better, tie = better | (tie & (x < y)), tie & (x == y)
        surplus += [new[~better & ~tie], old[better]]
        keep[hit[~better]] = False
        rest = rest[at < 0]
    out = list(_pieces("surplus", prefix, seq, pd.concat(surplus)))
    return out + list(_pieces("run", prefix, seq, best[keep]))


class MessageIndex:
    """Identifiers seen so far with the copy that is kept of each, in immutable runs in a shared folder.

    A run is, per hash prefix, the identifiers in arrays sorted by hash, with the kept copy's time and position.
    A batch is deduplicated within its tasks, sent to its prefixes, searched in the runs by bisection from the newest
    to the oldest, and leaves a new run; after merge_every runs they are merged into one. Losing rows are written
    with the run by the same job, so a batch is in the index wholly or not at all. A later batch may bring the better
    copy: the one kept before is then reported as surplus.

    A manifest in the folder names the runs that count; it is replaced after a run is written, so that another session
    that opens the same path finds the index as the last finished batch left it, and a run without an entry is nothing.
    The number of prefixes is the manifest's where there is one. One writer at a time."""

    def __init__(self, spark: SparkSession, prefixes: int = 64, merge_every: int = 3, path: str | None = None):
        self.spark, self.prefixes, self.merge_every = spark, prefixes, merge_every
        self.path = path or new_path(spark, "message-index")
        self.runs: list[str] = []
        self.lost: list[str] = []
        self.seq = 0
        known = read_text(spark, f"{self.path}/manifest.json")
        if known is not None:
            m = json.loads(known)
            self.runs, self.lost, self.seq, self.prefixes = ([f"{self.path}/{r}" for r in m["runs"]], [f"{self.path}/{r}" for r in m["lost"]], m["seq"], m["prefixes"])

    def _commit(self) -> None:
        names = lambda paths: [p.rsplit("/", 1)[1] for p in paths]
        write_text(self.spark, f"{self.path}/manifest.json", json.dumps({"runs": names(self.runs), "lost": names(self.lost), "seq": self.seq, "prefixes": self.prefixes}))

    def _kind(self, kind: str, paths: list[str]) -> DataFrame:
        frames = [self.spark.read.schema(_ARRAYS).parquet(p).where(F.col("kind") == kind) for p in paths]
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], _ARRAYS)

    def add(self, batch: DataFrame) -> None:
        """A batch of candidates (id, h, ts, ingest_date, part, off); h is a 64-bit hash of the id."""
        self.seq += 1
        seq, n, path = self.seq, self.prefixes, f"{self.path}/run-{self.seq:05d}"
        prefix = F.pmod(F.shiftright("h", 40), F.lit(n)).cast("int").alias("prefix")
        incoming = batch.select(prefix, *_ORDER)

        def settle(key: tuple, index: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            return _table(_settle(int(key[0]), index, rows, seq) if len(rows) else [])

        held = self._kind("run", self.runs)
        done = held.groupBy("prefix").cogroup(incoming.groupBy("prefix")).applyInPandas(settle, _ARRAYS)
        done.write.mode("overwrite").partitionBy("kind").parquet(path)
        self.runs.append(path)
        self.lost.append(path)
        self._commit()
        if len(self.runs) > self.merge_every:
            self.merge()

    def merge(self) -> None:
        """All runs into one; of an identifier in several runs the newest entry holds."""
        self.seq += 1
        seq, path = self.seq, f"{self.path}/run-{self.seq:05d}"

        def join(key: tuple, index: pd.DataFrame) -> pd.DataFrame:
            runs = [_run(index[index["seq"] == s]).assign(seq=s) for s in sorted(index["seq"].unique(), reverse=True)]
            b = pd.concat(runs).sort_values(["h", "id", "seq"], ascending=[True, True, False], kind="stable").drop_duplicates(["h", "id"])
            return _table(list(_pieces("run", int(key[0]), seq, b)))

        self._kind("run", self.runs).groupBy("prefix").applyInPandas(join, _ARRAYS).write.mode("overwrite").partitionBy("kind").parquet(path)
        old, self.runs = self.runs, [path]
        self._commit()
        for run in old:
            if run not in self.lost:
                remove_path(self.spark, run)

    def surplus(self) -> DataFrame:
        """(part, off, ingest_date) of every row that lost against another copy of its message."""
        lost = self._kind("surplus", self.lost)
        return lost.select(F.explode(F.arrays_zip("part", "off", "ingest")).alias("x")).select(F.col("x.part").alias("part"), F.col("x.off").alias("off"), F.col("x.ingest").alias("ingest_date"))

    def kept(self) -> DataFrame:
        """(id, part, off, ingest_date) of the copy kept of each message."""
        if len(self.runs) > 1:
            self.merge()
        return self._kind("run", self.runs).select(F.explode(F.arrays_zip("ids", "part", "off", "ingest")).alias("x")).select(F.col("x.ids").alias("id"), F.col("x.part").alias("part"), F.col("x.off").alias("off"), F.col("x.ingest").alias("ingest_date"))


def _local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b, first = _first_of_each(b)
        yield b.assign(lost=~first)


def surplus_messages(df: DataFrame, own: str = "offre_id", payload: str = "json", time: str = "kafka_ts", part: str = "kafka_partition", off: str = "kafka_offset", batch: str = "ingest_date", batches: int = 3, ids_per_prefix: int = 40_000, merge_every: int = 2) -> DataFrame:
    """The surplus rows of a message log (part, off, batch): all but one row of each identifier.

    Kept is the row with the latest time (null: before all others), then the earliest batch (null last), then the
    smallest part and offset. Rows without an identifier are never surplus; an empty identifier is one like any
    other. Rows equal in all five values are one row. Empty table: no rows. Other columns don't matter.

    The log is staged once as narrow rows. Copies that meet in a task lose there at once, so that an identifier with
    a third of all rows leaves at most one candidate per batch of Arrow rows; then the days are added to a
    MessageIndex in order, in a number of contiguous batches of about equal size."""
    spark = df.sparkSession
    ident = message_id(F.col(own), F.col(payload))
    ts = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(-(1 << 62)))
    rows = df.select(ident.alias("id"), ts.alias("ts"), F.coalesce(F.col(batch).cast("string"), F.lit("￿")).alias("ingest_date"), F.col(part).cast("int").alias("part"), F.col(off).cast("long").alias("off")).where(F.col("id").isNotNull()).select("id", F.xxhash64("id").alias("h"), "ts", "ingest_date", "part", "off")
    staged_at = new_path(spark, "messages")
    rows.mapInPandas(_local, f"{_CANDIDATE}, lost boolean").write.parquet(staged_at)
    staged = spark.read.schema(f"{_CANDIDATE}, lost boolean").parquet(staged_at)
    live = staged.where(~F.col("lost")).drop("lost")
    days = [(r[0], r[1]) for r in live.groupBy("ingest_date").count().orderBy("ingest_date").collect()]  # one row a day
    total, seen, cuts = sum(n for _, n in days), 0, []
    for d, n in days:
        seen += n
        if seen >= total * (len(cuts) + 1) / batches:
            cuts.append(d)
    index = MessageIndex(spark, prefixes=max(12, -(-total // ids_per_prefix)), merge_every=merge_every)
    low = None
    for top in cuts:
        index.add(live.where(F.col("ingest_date") <= top) if low is None else live.where((F.col("ingest_date") > low) & (F.col("ingest_date") <= top)))
        low = top
    lost = staged.where("lost").select("part", "off", "ingest_date").unionByName(index.surplus())
    return lost.select(F.col("part").alias(part), F.col("off").alias(off), F.nullif(F.col("ingest_date"), F.lit("￿")).alias(batch))
