"""Benchmark decontamination: passages of documents within an edit distance of benchmark items.

Words are compared, not characters. Every item and every window of a document of the item's size is embedded by
random walks (Chakraborty, Goldenberg and Koucky): a walk reads the current word at each step and goes on by a bit
that a random function draws from step and word, so that sequences a few edits apart are read alike again soon
after an edit, and a small edit distance becomes a small Hamming distance. Locality-sensitive hashing samples a few
places of an embedding; windows and items that agree in all places of one of the samples are candidates, and the
number of walks and samples sets the recall. Candidates are verified by exact edit distance.

Items of more than ``PART_WORDS`` words are cut into equal parts, each embedded on its own: of all edits allowed, some
part has at most its share. An edit breaks up two pairs of neighbouring words at most, so windows with fewer pairs
known from items than the edits allowed must leave can not match and are not embedded, which loses nothing. The items
are held in blocks of a fixed size; a document is read once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.jobs import prepare, without_ids
from lapwise.llm.texts import ALPHANUMERIC, mix, slices, texts_of, words_of

#: Edits allowed per word of an item.
EDIT_SHARE = 0.2
#: Walks, samples of each and places of each sample: of items at the full distance allowed, over nine in ten are found.
WALKS, SAMPLES, PLACES = 8, 6, 3
#: Longest part of an item that is embedded.
PART_WORDS = 64
#: Items, and words of items, a task holds at once.
BLOCK_ITEMS, BLOCK_WORDS = 20_000, 2_000_000

_PAD = np.uint64(0x5851F42D4C957F2D)


@dataclass(frozen=True)
class Walks:
    """Random walks and the places sampled from their embeddings; the same for items and windows."""

    edit_share: float = EDIT_SHARE
    walks: int = WALKS
    samples: int = SAMPLES
    places: int = PLACES
    seed: int = 11

    def edits(self, n: int) -> int:
        return int(self.edit_share * n)

    def sampled(self, width: int, walk: int) -> np.ndarray:
        """(samples x places) steps, in rising order, of the part of a walk that reads a window of ``width`` words."""
        rng = np.random.default_rng([self.seed, width, walk])
        steps = 2 * width
        return np.sort(np.stack([rng.choice(steps, min(self.places, steps), replace=False) for _ in range(self.samples)]), axis=1)

    def signatures(self, words: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
        """(windows x walks * samples) hashes of the sampled places of the windows that begin at ``start``."""
        out = np.zeros((len(start), self.walks * self.samples), dtype=np.uint64)
        stop = start + width
        for walk in range(self.walks):
            places = self.sampled(width, walk)
            block = out[:, walk * self.samples : (walk + 1) * self.samples]
            block[:] = np.uint64(walk + 1)
            at = start.copy()
            salt = mix(np.arange(2 * width, dtype=np.uint64) + np.uint64(self.seed * 1_000_003 + walk * 10_007)) | np.uint64(1)
            for step in range(int(places.max()) + 1):
                inside = at < stop
                word = np.where(inside, words[np.minimum(at, len(words) - 1)], _PAD)
                for sample in np.flatnonzero((places == step).any(axis=1)):
                    block[:, sample] = mix(block[:, sample] * np.uint64(0xD1342543DE82EF95) + word)
                at += ((word * salt[step]) >> np.uint64(63)).astype(np.int64)
        return out


def window_width(n: int) -> int:
    """Size of the windows for parts of ``n`` words: the next lower of a grid by quarters."""
    width = 1
    while (following := width + max(1, width // 4)) <= n:
        width = following
    return width


#: Places of the table that tells most pairs of words from those of items.
TABLE = 1 << 20


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the one after it."""
    return mix(words[:-1] * np.uint64(0xD1342543DE82EF95) + words[1:])


def _fresh(words: np.ndarray) -> np.ndarray:
    """Which pairs of neighbouring words are not two of the same word."""
    return words[:-1] != words[1:]


@dataclass
class Items:
    """A block of items, by size of window, with the signatures of their first words."""

    ids: list
    words: list[np.ndarray]
    walks: Walks
    pairs: np.ndarray = field(init=False)
    single: np.ndarray = field(init=False)
    table: np.ndarray = field(init=False)
    classes: dict[int, tuple[int, int, list]] = field(init=False)

    def __post_init__(self) -> None:
        none = np.zeros(0, dtype=np.uint64)
        self.pairs = np.unique(np.concatenate([none, *(_pairs(w) for w in self.words)]))
        self.single = np.concatenate([none, *(w for w in self.words if len(w) == 1)])
        self.table = np.zeros(TABLE, dtype=bool)
        self.table[self.pairs & np.uint64(TABLE - 1)] = True
        by_width: dict[int, list[tuple[int, int, int]]] = {}
        for i, words in enumerate(self.words):
            parts = -(-len(words) // PART_WORDS)
            cuts = [len(words) * k // max(parts, 1) for k in range(parts + 1)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                by_width.setdefault(window_width(high - low), []).append((i, low, high - low))
        self.classes = {}
        for width, members in by_width.items():
            item, offset, size = (np.array(c, dtype=np.int64) for c in zip(*members, strict=True))
            joined = np.concatenate([self.words[i][low : low + width] for i, low, _ in members])
            found = self.walks.signatures(joined, np.arange(len(members)) * width, width)
            tables = []
            for column in found.T:
                order = np.argsort(column, kind="stable")
                tables.append((column[order], item[order], offset[order]))
            edits = self.walks.edits(int(size.max()))
            # Runs of one word have few fresh pairs; an edit breaks up two and may make two more repeat.
            least = min(int(_fresh(part).sum()) for part in joined.reshape(len(members), width)) - 4 * edits
            self.classes[width] = (edits, least, tables)

    def _known(self, pairs: np.ndarray) -> np.ndarray:
        """Which pairs of words are in some item: a table rules most out, the rest are looked up."""
        known = self.table[pairs & np.uint64(TABLE - 1)]
        maybe = np.flatnonzero(known)
        if len(maybe):
            place = np.minimum(np.searchsorted(self.pairs, pairs[maybe]), len(self.pairs) - 1)
            known[maybe] = self.pairs[place] == pairs[maybe]
        return known

    def candidates(self, words: np.ndarray, bounds: np.ndarray):
        """(first word, item): where an item may begin, by windows that agree with a part of it in some sample."""
        none = np.zeros(0, dtype=np.int64)
        if not len(words):
            return none, none
        # What follows the end of all rows is in no item.
        widest = max(self.classes, default=1)
        padded = np.concatenate([words, np.full(widest, _PAD, dtype=np.uint64)])
        known = self._known(_pairs(padded))
        inside, fresh = (np.zeros(len(padded), dtype=np.int32) for _ in range(2))
        np.cumsum(known, out=inside[1:])
        np.cumsum(known & _fresh(padded), out=fresh[1:])
        starts, items = [], []
        for width, (edits, least, tables) in self.classes.items():
            if width == 1:
                hopeful = np.flatnonzero(np.isin(words, self.single))
            else:
                kept = inside[width - 1 : width - 1 + len(words)] - inside[: len(words)]
                new = fresh[width - 1 : width - 1 + len(words)] - fresh[: len(words)]
                hopeful = np.flatnonzero((kept >= width - 1 - 2 * edits) & (new >= least))
            for first in range(0, len(hopeful), 65_536):
                self._look_up(padded, bounds, hopeful[first : first + 65_536], width, tables, starts, items)
        if not starts:
            return none, none
        pairs = np.unique(np.stack([np.concatenate(items), np.concatenate(starts)], axis=1), axis=0)
        return pairs[:, 1], pairs[:, 0]

    def _look_up(self, words, bounds, start, width, tables, starts, items) -> None:
        found = self.walks.signatures(words, start, width)
        row_start = bounds[np.searchsorted(bounds, start, side="right") - 1]
        for column, (known, item, offset) in zip(found.T, tables, strict=True):
            low, high = np.searchsorted(known, column, side="left"), np.searchsorted(known, column, side="right")
            times = high - low
            if times.any():
                which = np.repeat(np.arange(len(column)), times)
                entry = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
                starts.append(np.maximum(start[which] - offset[entry], row_start[which]))
                items.append(item[entry])


def best_alignment(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, stop) of the part of ``region`` nearest to the item; ties: ends first, then the longest."""

    def ends(pattern, text):
        across = np.arange(len(text) + 1)
        row = np.zeros(len(text) + 1, dtype=np.int64)
        for i, word in enumerate(pattern):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[:-1] + (text != word), row[1:] + 1)
            row = np.minimum.accumulate(new - across) + across
        return row

    last = ends(item, region)
    stop = int(np.argmin(last))
    edits = int(last[stop])
    # The same from the back, for a part that must end at ``stop``.
    back = region[:stop][::-1]
    across = np.arange(len(back) + 1)
    row = across.copy()
    for i, word in enumerate(item[::-1]):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[:-1] + (back != word), row[1:] + 1)
        row = np.minimum.accumulate(new - across) + across
    length = int(np.flatnonzero(row == edits)[-1])
    return edits, stop - length, stop


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    walks: Walks = Walks(),
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """(doc id, item id, ``first_word``, ``n_words``, ``item_words``, ``edits``) of passages near an item.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case, so marks and
    case make no difference. A passage is reported if at most ``edit_share`` edits per word of the item turn one
    into the other; short items must be there word for word. Items without words match nothing, items that repeat
    are each reported, and a document may hold several passages of one item. Null texts have no words. Document ids
    may be null or repeat; columns beyond those named are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = f"id {kind}, item long, first_word long, n_words long, item_words long, edits long"
    found = None
    for block in _item_blocks(benchmark, item_column, item_text_column, walks, block_items):
        part = rows.mapInArrow(_search(spark.sparkContext.broadcast(block)), schema)
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    return found.withColumnsRenamed({"id": id_column, "item": item_column})


def _item_blocks(benchmark: DataFrame, item_column: str, text_column: str, walks: Walks, block_items: int):
    ids, words, held = [], [], 0
    rows = benchmark.select(F.col(item_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    for row in rows.where("text IS NOT NULL").orderBy("id", "text").toLocalIterator():
        own = words_of(texts_of(pa.array([row["text"]], pa.large_string())), ALPHANUMERIC).hash
        if ids and (len(ids) >= block_items or held + len(own) > BLOCK_WORDS):
            yield Items(ids, words, walks)
            ids, words, held = [], [], 0
        ids.append(row["id"])
        words.append(own)
        held += len(own)
    if ids:
        yield Items(ids, words, walks)


def _search(shared) -> Callable:
    def search(batches):
        items = shared.value
        for batch, texts in slices(batches, "text"):
            words = words_of(texts, ALPHANUMERIC)
            found = [
                (r, items.ids[i], *passage)
                for r, i, passage in passages(items, words.hash, words.bounds)
            ]
            if found:
                row, *columns = zip(*found, strict=True)
                ids = batch.column(0).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(c, pa.int64()) for c in columns)],
                    names=["id", "item", "first_word", "n_words", "item_words", "edits"],
                )

    return search


def passages(items: Items, words: np.ndarray, bounds: np.ndarray):
    """(row, item, (first word, words, words of the item, edits)) of verified passages.

    Candidate windows of one item that lie within its length of each other are verified as one region.
    """
    start, item = items.candidates(words, bounds)
    row = np.searchsorted(bounds, start, side="right") - 1
    k = 0
    while k < len(start):
        own = items.words[item[k]]
        edits = items.walks.edits(len(own))
        last = k
        while last + 1 < len(start) and item[last + 1] == item[k] and row[last + 1] == row[k] and start[last + 1] - start[last] <= len(own):
            last += 1
        low = max(int(start[k]) - edits - len(own) // 2, int(bounds[row[k]]))
        high = min(int(start[last]) + len(own) + edits + len(own) // 2, int(bounds[row[k] + 1]))
        base = int(bounds[row[k]])
        parts = [(low, high)]
        while parts:
            low, high = parts.pop()
            if high - low < len(own) - edits:
                continue
            # Words of the item that are not there each cost an edit.
            if np.isin(own, words[low:high]).sum() < len(own) - edits:
                continue
            distance, first, stop = best_alignment(own, words[low:high])
            if distance <= edits and stop > first:
                yield int(row[k]), int(item[k]), (low + first - base, stop - first, len(own), distance)
                # More copies may lie before and after.
                parts += [(low, low + first), (low + stop, high)]
        k = last + 1


def decontaminated(docs: DataFrame, leaks: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents without a leak. Rows that share an id stay or go together; rows without id stay."""
    return without_ids(docs, leaks.select(id_column), id_column)
