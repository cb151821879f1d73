"""Line dedup that can be undone: exact counts of documents per line, and cuckoo filters of the lines to drop.

A line's key is a 128-bit digest of the line without white space at its ends, A-Z in lower case. An index holds

* exact counts: in how many documents each key stands. Every update adds a table with the keys that it touches, so that
  a small update does not rewrite what is there; tables are merged when they become many.
* a cuckoo filter per shard of keys, with a 16-bit fingerprint of each key that has reached the threshold. Unlike other
  filters, it also forgets: a key goes in when its exact count reaches the threshold and out when it falls below, so
  that every deletion takes out what an insertion put in. A filter that runs full is built anew, larger, from the counts.

Filters answer for nearly all lines that they stay. What passes is decided by exact counts, so no line goes by mistake.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, scored_rows, with_kept, written
from lapwise.llm.texts import mix, slices

KEY_BYTES = 16
#: Keys counted in a task before their counts are handed on.
COUNTED_KEYS = 200_000
#: Filters, and the exact keys beside them, are sent to all tasks up to this size; beyond it lines are joined with counts.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
#: Tables of counts before they are merged into one.
MAX_GENERATIONS = 8

SLOTS, MAX_KICKS, MAX_LOAD = 4, 500, 0.85

_COUNTS = "shard int, key binary, documents long"
_FILTERS = "shard int, buckets long, slots binary"


class CuckooFilter:
    """16-bit fingerprints in buckets of four slots. Each key has two buckets; either may hold its fingerprint."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def empty(cls, buckets: int) -> CuckooFilter:
        return cls(np.zeros(buckets * SLOTS, dtype=np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray, buckets: int) -> CuckooFilter:
        """Holds all the keys, in more than ``buckets`` buckets if it must."""
        while True:
            made = cls.empty(buckets)
            if made.add(keys):
                return made
            buckets *= 2

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint and both buckets of each key (rows of two 64-bit numbers)."""
        mask = np.uint64(len(self.slots) - 1)
        prints = (keys[:, 1] >> np.uint64(48)) | np.uint64(1)
        first = keys[:, 0] & mask
        return prints.astype(np.uint16), first, first ^ (mix(prints) & mask)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        prints = prints[:, None]
        return (self.slots[first] == prints).any(axis=1) | (self.slots[second] == prints).any(axis=1)

    def add(self, keys: np.ndarray) -> bool:
        """Whether all keys found room; if not, the filter is not to be used any more."""
        mask = len(self.slots) - 1
        for print_, first, second in zip(*(a.tolist() for a in self.places(keys))):
            if self._put(first, print_) or self._put(second, print_):
                continue
            bucket = second
            for kick in range(MAX_KICKS):
                # The slots take turns, so that a filter is the same however often it is built.
                slot = kick % SLOTS
                print_, self.slots[bucket, slot] = int(self.slots[bucket, slot]), print_
                bucket ^= int(mix(np.array([print_], dtype=np.uint64))[0]) & mask
                if self._put(bucket, print_):
                    break
            else:
                return False
        return True

    def _put(self, bucket: int, print_: int) -> bool:
        free = np.flatnonzero(self.slots[bucket] == 0)
        if len(free):
            self.slots[bucket, free[0]] = print_
        return len(free) > 0

    def discard(self, keys: np.ndarray) -> None:
        """Only for keys that were added: another's fingerprint might go instead of one that was not."""
        for print_, first, second in zip(*(a.tolist() for a in self.places(keys))):
            for bucket in (first, second):
                found = np.flatnonzero(self.slots[bucket] == print_)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break


def buckets_for(keys: int) -> int:
    return 1 << max(int(np.ceil(np.log2(max(keys, 1) / (SLOTS * MAX_LOAD)))), 0)


def _keys(raw: bytes, least_chars: int) -> list[bytes | None]:
    """A key per line; none for lines that are too short to go."""
    # On bytes, strip() takes off 0x20 and 0x09 to 0x0D, and lower() changes A to Z, no others.
    found = []
    for line in raw.split(b"\n"):
        bare = line.strip().lower()
        if len(bare) < least_chars or (least_chars > 1 and len(bare.decode()) < least_chars):
            found.append(None)
        else:
            found.append(blake2b(bare, digest_size=KEY_BYTES).digest())
    return found


def _as_numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<u8").reshape(-1, 2)


def _shards(numbers: np.ndarray, shards: int) -> np.ndarray:
    # By other bits than buckets and fingerprints.
    return ((numbers[:, 1] & np.uint64(0xFFFFFFFF)) % np.uint64(shards)).astype(np.int32)


@dataclass(frozen=True)
class LineIndex:
    """Exact counts in ``generations`` (shard, key, documents: what an update added or took) and one filter per shard."""

    generations: tuple[DataFrame, ...]
    filters: DataFrame
    least_documents: int
    least_chars: int
    shards: int

    @property
    def counts(self) -> DataFrame:
        """(shard, key, documents) of every key that some document holds."""
        rows = reduce(DataFrame.unionByName, self.generations)
        summed = rows if len(self.generations) == 1 else rows.groupBy("shard", "key").agg(F.sum("documents").alias("documents"))
        return summed.where("documents > 0")

    @property
    def frequent(self) -> DataFrame:
        return self.counts.where(F.col("documents") >= self.least_documents)

    def insert(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """With the lines of more documents. Each row is a document, also one that is there already."""
        return self._updated(docs, text, 1)

    def remove(self, docs: DataFrame, text: str = "text") -> LineIndex:
        """Without documents that were inserted, given with their texts; ones that were not make the update fail."""
        return self._updated(docs, text, -1)

    def _updated(self, docs: DataFrame, text: str, sign: int) -> LineIndex:
        changes = line_counts(docs, text, self.least_chars, self.shards).withColumn("documents", F.col("documents") * sign)
        if self.generations:
            # Only keys that the update touches are summed; Spark sends a small update to where the counts are.
            changes = written(changes, "line-changes")
            known = reduce(DataFrame.unionByName, self.generations).join(changes.select("key"), "key", "left_semi")
            known = known.groupBy("shard", "key").agg(F.sum("documents").alias("before"))
            touched = changes.join(known, ["shard", "key"], "left").withColumn("before", F.coalesce("before", F.lit(0)))
        else:
            touched = changes.withColumn("before", F.lit(0).cast("long"))
        after = F.col("before") + F.col("documents")
        unknown = F.raise_error(F.lit("a document that is to be removed was never inserted"))
        touched = written(touched.withColumn("after", F.when(after < 0, unknown).otherwise(after).cast("long")), "line-counts")

        made = replace(self, generations=(*self.generations, touched.select("shard", "key", "documents")))
        reached = F.col("after") >= self.least_documents
        crossing = touched.where(reached != (F.col("before") >= self.least_documents)).select("shard", "key", reached.alias("added"))
        made = replace(made, filters=_updated_filters(made, crossing))
        if len(made.generations) > MAX_GENERATIONS:
            made = replace(made, generations=(written(made.counts, "line-counts"),))
        return made


def line_index(spark: SparkSession, least_documents: int = 10, least_chars: int = 1, shards: int = 256) -> LineIndex:
    """An index without documents. Lines of ``least_chars`` code points or more count, without the white space at their
    ends; those in ``least_documents`` documents are to go. A shard's frequent keys have to fit one task."""
    if least_chars < 1 or least_documents < 1:
        raise ValueError("lines need a character, and a document that holds them")
    return LineIndex((), spark.createDataFrame([], _FILTERS), least_documents, least_chars, shards)


def line_counts(docs: DataFrame, text: str, least_chars: int, shards: int) -> DataFrame:
    """(shard, key, documents): in how many rows each key stands. Counted within tasks first."""
    prepare(docs.sparkSession)

    def count(batches):
        counts: dict[bytes, int] = {}
        for batch, texts in slices(batches, "text"):
            for row in range(batch.num_rows):
                for key in set(_keys(texts.raw(row), least_chars)):
                    counts[key] = counts.get(key, 0) + 1
                if len(counts) > COUNTED_KEYS:
                    yield hand_on(counts)
                    counts = {}
        yield hand_on(counts)

    def hand_on(counts):
        counts.pop(None, None)
        keys = list(counts)
        return pa.RecordBatch.from_pydict(
            {
                "shard": _shards(_as_numbers(keys), shards),
                "key": pa.array(keys, pa.binary()),
                "documents": pa.array(list(counts.values()), pa.int64()),
            }
        )

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, _COUNTS)
    return found.groupBy("shard", "key").agg(F.sum("documents").alias("documents"))


def _updated_filters(index: LineIndex, crossing: DataFrame) -> DataFrame:
    """The filters after keys have reached the threshold or fallen below it; (shard, buckets, slots)."""
    prepare(crossing.sparkSession)

    def update(known: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
        shard = int((known if len(known) else changes)["shard"].iloc[0])
        if not len(known):  # nothing to go on from
            return pd.DataFrame({"shard": [shard], "buckets": [1], "slots": [None]})
        kept = CuckooFilter(np.frombuffer(known["slots"].iloc[0], dtype=np.uint16).copy())
        gone, come = changes[~changes["added"]], changes[changes["added"]]
        kept.discard(_as_numbers(list(gone["key"])))
        room = int((kept.slots == 0).sum()) - (1 - MAX_LOAD) * kept.slots.size
        if len(come) > room or not kept.add(_as_numbers(list(come["key"]))):
            return pd.DataFrame({"shard": [shard], "buckets": [2 * len(kept.slots)], "slots": [None]})
        return pd.DataFrame({"shard": [shard], "buckets": [len(kept.slots)], "slots": [kept.slots.tobytes()]})

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        buckets = max(buckets_for(len(keys)), int(keys["buckets"].iloc[0]))
        made = CuckooFilter.of(_as_numbers(list(keys["key"])), buckets)
        return pd.DataFrame({"shard": [int(keys["shard"].iloc[0])], "buckets": [len(made.slots)], "slots": [made.slots.tobytes()]})

    updated = written(index.filters.groupBy("shard").cogroup(crossing.groupBy("shard")).applyInPandas(update, _FILTERS), "line-filters")
    full = updated.where("slots IS NULL").select("shard", "buckets")
    built = index.frequent.join(full, "shard").select("shard", "key", "buckets").groupBy("shard").applyInPandas(build, _FILTERS)
    return written(updated.where("slots IS NOT NULL").unionByName(built), "line-filters")


def drop_lines(docs: DataFrame, index: LineIndex, id_column: str = "doc_id", text_column: str = "text", most_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: id, n_lines (before), n_dropped, kept (the other lines, joined by line breaks).

    A null or empty text is one empty line, which stays. Repeated ids are documents of their own, null ids too. Other
    columns are ignored. The documents need not be those of the index.
    """
    spark = docs.sparkSession
    prepare(spark)
    least = index.least_chars
    bytes_of = index.filters.agg(F.sum(F.length("slots")), F.count(F.lit(1))).first()
    if not bytes_of[1]:
        frequent = 0
    else:
        frequent = index.frequent.count()
    filters = _shipped(spark, index.filters.collect(), index.shards) if (bytes_of[0] or 0) <= most_bytes else None
    if filters is not None and frequent * KEY_BYTES <= most_bytes:
        exact = spark.sparkContext.broadcast(_sorted_keys(index.frequent) if frequent else np.zeros(0, dtype="V16"))

        def decide(batches):
            for batch, texts in slices(batches, "text"):
                keys, rows = _batch_keys(texts, least)
                passed = np.flatnonzero(_passes(filters, keys, index_shards))
                drop = _is_in(exact.value, keys[passed])
                yield _without(batch, texts, rows, set(passed[drop].tolist()))

        index_shards = index.shards
        return scored_rows(docs, decide, _KEPT, id_column, text_column)
    return _dropped_by_join(docs, index, filters, id_column, text_column)


_KEPT = "n_lines long, n_dropped long, kept string"


def _shipped(spark, rows, shards):
    """All filters in one broadcast: slots one after another, and per shard its first bucket and its mask."""
    first, mask = np.full(shards, -1, dtype=np.int64), np.zeros(shards, dtype=np.uint64)
    parts, total = [], 0
    for row in sorted(rows):
        first[row["shard"]], mask[row["shard"]] = total, row["buckets"] - 1
        parts.append(np.frombuffer(row["slots"], dtype=np.uint16).reshape(-1, SLOTS))
        total += row["buckets"]
    slots = np.concatenate(parts) if parts else np.zeros((0, SLOTS), dtype=np.uint16)
    return spark.sparkContext.broadcast((slots, first, mask))


def _passes(filters, keys: np.ndarray, shards: int) -> np.ndarray:
    """Which keys their shard's filter holds; filters of all shards are looked up at once."""
    slots, first, mask = filters.value
    out = np.zeros(len(keys), dtype=bool)
    if not len(slots) or not len(keys):
        return out
    shard = _shards(keys, shards)
    known = np.flatnonzero(first[shard] >= 0)
    keys, shard = keys[known], shard[known]
    prints = (keys[:, 1] >> np.uint64(48)) | np.uint64(1)
    near = keys[:, 0] & mask[shard]
    far = near ^ (mix(prints) & mask[shard])
    wanted = prints.astype(np.uint16)[:, None]
    held = [(slots[first[shard] + at.astype(np.int64)] == wanted).any(axis=1) for at in (near, far)]
    out[known] = held[0] | held[1]
    return out


def _batch_keys(texts, least_chars: int) -> tuple[np.ndarray, list[list[int]]]:
    """Keys of all lines of a slice, and per row the place of each line's key in them (-1 without)."""
    keys, rows = [], []
    for row in range(len(texts)):
        places = []
        for key in _keys(texts.raw(row), least_chars):
            places.append(-1 if key is None else len(keys))
            if key is not None:
                keys.append(key)
        rows.append(places)
    return _as_numbers(keys), rows


def _sorted_keys(keys: DataFrame) -> np.ndarray:
    found = keys.select("key").toArrow().column(0)
    return np.sort(np.frombuffer(b"".join(found.to_pylist()), dtype="S16").view("V16")) if len(found) else np.zeros(0, dtype="V16")


def _is_in(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys are among the sorted ``known`` ones, compared by all their bytes."""
    if not len(known) or not len(keys):
        return np.zeros(len(keys), dtype=bool)
    return np.isin(np.ascontiguousarray(keys).view("V16").ravel(), known)


def _without(batch: pa.RecordBatch, texts, rows: list[list[int]], drop: set[int]) -> pa.RecordBatch:
    """The rows of a slice without the lines whose keys are at the places ``drop``."""
    kept, dropped = [], []
    for row, places in enumerate(rows):
        raw = texts.raw(row)
        stays = [place not in drop for place in places]
        if all(stays):
            kept.append(raw)
        else:
            kept.append(b"\n".join(line for line, stay in zip(raw.split(b"\n"), stays) if stay))
        dropped.append(len(stays) - sum(stays))
    found = {
        "n_lines": pa.array([len(places) for places in rows], pa.int64()),
        "n_dropped": pa.array(dropped, pa.int64()),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()),
    }
    return with_kept(batch, found)


def _dropped_by_join(docs, index: LineIndex, filters, id_column: str, text_column: str) -> DataFrame:
    """The same where exact keys are too many to be sent to all tasks: keys that pass go to the counts, what is to go
    comes back to the row. Rows are written with a number first, which holds however often a task runs."""
    spark = docs.sparkSession
    least, shards = index.least_chars, index.shards
    numbered = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    numbered = written(numbered.withColumn("row", F.monotonically_increasing_id()), "line-documents")

    def pairs(batches):
        for batch, texts in slices(batches, "text"):
            keys, rows = _batch_keys(texts, least)
            passed = np.ones(len(keys), dtype=bool) if filters is None else _passes(filters, keys, shards)
            ids = batch.column(0).to_pylist()
            found = {(ids[i], keys[p].tobytes()) for i, places in enumerate(rows) for p in places if p >= 0 and passed[p]}
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())], names=["row", "key"]
            )

    candidates = numbered.select("row", "text").mapInArrow(pairs, "row long, key binary")
    gone = candidates.join(index.frequent.select("key"), "key").groupBy("row").agg(F.collect_list("key").alias("gone"))
    both = numbered.join(gone, "row", "left").select("id", "text", F.col("gone").alias("_keep0"))

    def decide(batches):
        for batch, texts in slices(batches, "text"):
            gone = batch.column(2).to_pylist()
            found = []
            for row in range(batch.num_rows):
                go, raw = set(gone[row] or ()), texts.raw(row)
                lines = raw.split(b"\n")
                kept = [line for line, key in zip(lines, _keys(raw, least)) if key not in go] if go else lines
                found.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), columns[0], columns[1], columns[2].cast(pa.string())], names=["id", "n_lines", "n_dropped", "kept"])

    kind = docs.schema[id_column].dataType.simpleString()
    return both.mapInArrow(decide, f"id {kind}, {_KEPT}").withColumnRenamed("id", id_column)
