"""Benchmark decontamination by CGK embeddings, bit sampling and exact edit distances.

Texts and items are sequences of lower-case words (letters and digits, punctuation dropped).
A document is contaminated by an item of n words if some run of its words is within
floor((1 - SIMILARITY) * n) word edits of the item.

1. *Windows.* A run within e edits keeps n - 1 - 2e pairs of neighbouring words of the item, so
   only places with that many item pairs in n + e words are looked at. This loses nothing.
2. *Embedding.* The CGK walk reads a window from its start and at each step stays or moves on
   by a random bit of (step, word); small edit distance becomes small Hamming distance. A walk
   does not depend on the window's end, so one walk serves item-sized windows of all items.
3. *Bit sampling.* Each of several walks is sampled at several random sets of steps; a window
   that agrees with an item in one set is a candidate. Items are indexed from groups of starts
   over their whole length, so that edits bunched in one place leave other groups untouched.
4. *Verification* by bit-parallel edit distance over the candidate's surroundings, exactly.

Items are broadcast in blocks of a bounded number of words; more blocks mean more passes
over the documents, never a larger broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks

SIMILARITY = 0.8
WALKS, SETS, STEPS = 6, 8, 24
STARTS, EVERY = 12, 24
ITEM_BYTES = 2 << 20
# Places looked at together; what they match is held at once.
PLACES = 2048

_LOWER = blocks.lower_ascii()
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_WORD[128:] = True


def word_sequences(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each text, and where each text's begin."""
    data, offsets = blocks.text_bytes(column)
    starts, ends, first = blocks.words(data, offsets, _WORD)
    return blocks.word_hashes(_LOWER[data], starts, ends, 4), first


def _constant(n: int) -> np.uint64:
    return np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))


def walk(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, number: int) -> np.ndarray:
    """The word read at each step by the walk of this number from each start; 0 past the end."""
    at = starts.copy()
    out = np.zeros((len(starts), STEPS), np.uint64)
    for step in range(STEPS):
        inside = at < ends
        read = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        out[:, step] = read
        at += (blocks.mix(read + _constant(number * STEPS + step + 1)) >> np.uint64(63)).astype(at.dtype) & inside
    return out


def sampled_steps(seed: int = 7) -> list[list[tuple[int, int]]]:
    """Pairs of steps for each walk, half of them early; a pair of equal steps is one step."""
    random = np.random.default_rng(seed)
    sets = []
    for _ in range(WALKS):
        early = [tuple(sorted(random.choice(8, 2, replace=False))) for _ in range(SETS // 2)]
        late = [tuple(sorted(random.choice(STEPS, 2, replace=False))) for _ in range(SETS // 2)]
        sets.append(early + late)
    return sets


def item_starts(n: int) -> list[int]:
    """Words of an item of n words from which walks start: groups of STARTS, one EVERY so many words."""
    later = [s for first in range(EVERY, n, EVERY) for s in range(first, min(first + STARTS, n - 1))]
    return [*range(min(STARTS, max(n // 2, 1))), *later]


class Index:
    """A block of benchmark items, ready to be broadcast."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float = SIMILARITY):
        words, first = word_sequences(pa.array(texts, pa.string()))
        full = np.flatnonzero(np.diff(first))
        self.ids = [ids[i] for i in full]
        self.items = [words[first[i] : first[i + 1]] for i in full]
        self.edits = [int((1 - similarity) * len(w) + 1e-9) for w in self.items]
        pairs = [pair_hashes(w) for w in self.items]
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *pairs]))
        # Spans and least numbers of pairs, of which a window has to meet one, and how far behind
        # the start of such a window walks of its items start.
        needs: dict[int, tuple[int, int]] = {}
        for w, e in zip(self.items, self.edits, strict=True):
            span, least, reach = len(w) + e, max(len(w) - 1 - 2 * e, 0), max(item_starts(len(w))[-1] + e, STARTS + max(self.edits))
            known = needs.get(span, (least, reach))
            needs[span] = min(known[0], least), max(known[1], reach)
        self.needs = [(span, least, reach) for span, (least, reach) in sorted(needs.items())]
        item, start = [], []
        for i, w in enumerate(self.items):
            for s in item_starts(len(w)):
                item.append(i)
                start.append(s)
        self.item, self.start = np.array(item, np.int64), np.array(start, np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *self.items])
        base = np.concatenate([[0], np.cumsum([len(w) for w in self.items])])
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for number, key, rows in signatures(flat, base[self.item] + self.start, base[self.item + 1], short=True) if self.items else ():
            keys.append(key)
            owners.append(rows)
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.size = np.array([len(w) for w in self.items], np.int64)
        self.edit = np.array(self.edits, np.int64)
        # The pairs that a run within the edits must keep, and which items have which pair.
        self.least = np.maximum(self.size - 1 - 2 * self.edit, 0)
        owner = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
        flat = np.concatenate([np.zeros(0, np.uint64), *pairs])
        order = np.lexsort((owner, flat))
        fresh = blocks.first_in_group(flat[order]) | blocks.first_in_group(owner[order])
        self.pair_keys, self.pair_items = flat[order][fresh], owner[order][fresh].astype(np.int64)
        self.masks = [masks(w) for w in self.items]
        # The same for items of one machine word, by a key of item and word.
        short = [(i, w, m) for i, own in enumerate(self.masks) if self.size[i] <= 64 for w, m in own.items()]
        keys = _place_keys(np.array([i for i, _, _ in short], np.int64), np.array([w for _, w, _ in short], np.uint64))
        order = np.argsort(keys)
        self.place_keys, self.place_masks = keys[order], np.array([m for _, _, m in short], np.uint64)[order]


def pair_hashes(words: np.ndarray) -> np.ndarray:
    return blocks.mix(words[:-1] * np.uint64(3) + words[1:])


def signatures(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: bool = False):
    """(walk, keys, rows) of every sampled set; single steps too, but in the index only for short items."""
    for number, sets in enumerate(sampled_steps()):
        out = walk(words, starts, ends, number)
        for i, (a, b) in enumerate(sets):
            rows = np.flatnonzero(out[:, b])
            yield number, blocks.mix(out[rows, a] * np.uint64(5) + out[rows, b] + np.uint64(number * 64 + i)), rows
        for step in range(3):
            rows = np.flatnonzero((out[:, step] != 0) & (ends - starts < 10)) if short else np.flatnonzero(out[:, step])
            yield number, blocks.mix(out[rows, step] + _constant(number * 64 + 32 + step)), rows


def masks(words: np.ndarray) -> dict[int, int]:
    """For each word of an item, the bits of its places."""
    out: dict[int, int] = {}
    for place, word in enumerate(words.tolist()):
        out[word] = out.get(word, 0) | 1 << place
    return out


def _place_keys(item: np.ndarray, words: np.ndarray) -> np.ndarray:
    return blocks.mix(words + item.astype(np.uint64) * _constant(3))


def all_within_edits(index: Index, words: np.ndarray, item: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``within_edits`` of many items of at most 64 words, each in its run [lower, upper) of the words."""
    size = index.size[item].astype(np.uint64)
    every, top, one = ~np.uint64(0) >> (np.uint64(64) - size), np.uint64(1) << (size - np.uint64(1)), np.uint64(1)
    up, down, distance = every.copy(), np.zeros(len(item), np.uint64), index.size[item].copy()
    near = distance <= index.edit[item]
    for step in range(int((upper - lower).max(initial=0))):
        inside = lower + step < upper
        key = _place_keys(item, words[np.minimum(lower + step, len(words) - 1)])
        at = np.minimum(np.searchsorted(index.place_keys, key), len(index.place_keys) - 1)
        equal = np.where(index.place_keys[at] == key, index.place_masks[at], np.uint64(0))
        cross = equal | down
        level = (((equal & up) + up) ^ up) | equal
        rise, fall = down | (~(level | up) & every), up & level
        distance += (rise & top != 0).astype(np.int64) - (fall & top != 0)
        near |= inside & (distance <= index.edit[item])
        # A run may begin anywhere: the first row stays zero, so nothing is carried in.
        rise, fall = rise << one & every, fall << one & every
        up, down = fall | (~(cross | rise) & every), rise & cross
    return near


def within_edits(places: dict[int, int], n: int, text: list[int], edits: int) -> bool:
    """Whether an item of n words is within so many edits of some run of the text (bit-parallel)."""
    # Such a run keeps all words of the item but one for each edit.
    if sum(map(places.__contains__, text)) < n - edits:
        return False
    all_bits, top = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = all_bits, 0, n
    if distance <= edits:
        return True
    for word in text:
        equal = places.get(word, 0)
        cross = equal | down
        level = (((equal & up) + up) ^ up) | equal
        rise, fall = down | ~(level | up) & all_bits, up & level
        distance += bool(rise & top) - bool(fall & top)
        if distance <= edits:
            return True
        # A run may begin anywhere: the first row stays zero, so nothing is carried in.
        rise, fall = rise << 1 & all_bits, fall << 1 & all_bits
        up, down = fall | ~(cross | rise) & all_bits, rise & cross
    return False


def found_items(index: Index, words: np.ndarray, first: np.ndarray) -> list[list[int]]:
    """Ids of the items that each text holds, in order."""
    n = len(first) - 1
    found: list[set[int]] = [set() for _ in range(n)]
    if not index.items or len(words) == 0:
        return [[] for _ in range(n)]
    row = np.repeat(np.arange(n), np.diff(first))
    hit = np.zeros(len(words) + 1, np.int64)
    if len(words) > 1 and len(index.pairs):
        pair = pair_hashes(words)
        at = np.minimum(np.searchsorted(index.pairs, pair), len(index.pairs) - 1)
        np.cumsum((index.pairs[at] == pair) & (row[1:] == row[:-1]), out=hit[1:-1])
        hit[-1] = hit[-2]
    starts = _near_enough_pairs(index, first, row, hit)
    if len(starts) == 0:
        return [[] for _ in range(n)]
    places = _item_pairs(index, words, hit)
    for at in range(0, len(starts), PLACES):
        own = starts[at : at + PLACES]
        item, begin = _candidates(index, words, own, first[row[own] + 1])
        text = row[np.clip(begin[:, 1], 0, len(row) - 1)]
        lower, upper = np.maximum(first[text], begin[:, 0]), np.minimum(first[text + 1], begin[:, 2])
        kept = np.searchsorted(places, item * (len(words) + 1) + upper) - np.searchsorted(places, item * (len(words) + 1) + lower) >= index.least[item]
        item, text, lower, upper = item[kept], text[kept], lower[kept], upper[kept]
        short = index.size[item] <= 64
        for part in np.array_split(np.flatnonzero(short), -(-np.count_nonzero(short) // 4096) or 1):
            near = part[all_within_edits(index, words, item[part], lower[part], upper[part])]
            for i, r in zip(item[near].tolist(), text[near].tolist(), strict=True):
                found[r].add(index.ids[i])
        for i, r, a, b in zip(item[~short].tolist(), text[~short].tolist(), lower[~short].tolist(), upper[~short].tolist(), strict=True):
            if index.ids[i] not in found[r] and within_edits(index.masks[i], len(index.items[i]), words[a:b].tolist(), index.edits[i]):
                found[r].add(index.ids[i])
    return [sorted(f) for f in found]


def _near_enough_pairs(index: Index, first: np.ndarray, row: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Places in a window with as many item pairs as some item needs, up to the last start of its walks."""
    pairs = np.flatnonzero(np.diff(hit))
    begins, stops = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for span, least, reach in index.needs:
        if least == 0:
            return np.arange(len(row))
        low, high = pairs[: max(len(pairs) - least + 1, 0)], pairs[least - 1 :]
        enough = (high - low <= span - 2) & (row[high] == row[low])
        low, high = low[enough], high[enough]
        begins.append(np.maximum(high - span + 2, first[row[low]]))
        # A walk may start anywhere in the window.
        stops.append(low + 1 + reach)
    begins, stops = np.concatenate(begins), np.concatenate(stops)
    edge = np.bincount(begins, minlength=len(row) + 1) - np.bincount(np.minimum(stops, len(row)), minlength=len(row) + 1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def _item_pairs(index: Index, words: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Sorted item * (words + 1) + place of every place where a pair of that item stands."""
    at = np.flatnonzero(np.diff(hit))
    pair = pair_hashes(words)[at] if len(at) else np.zeros(0, np.uint64)
    low, high = (np.searchsorted(index.pair_keys, pair, side) for side in ("left", "right"))
    counts = high - low
    which = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(at) else np.zeros(0, np.int64)
    return np.sort(index.pair_items[which] * (len(words) + 1) + np.repeat(at, counts))


def _candidates(index: Index, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items and (from, matched start, to) of the windows that share a sampled key with them."""
    marks = [np.zeros((0, 3), np.int64)]
    for _, key, rows in signatures(words, starts, ends):
        low, high = (np.searchsorted(index.keys, key, side) for side in ("left", "right"))
        counts = high - low
        known = counts > 0
        low, counts = low[known], counts[known]
        which = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(low) else np.zeros(0, np.int64)
        owner = index.owners[which]
        start = np.repeat(starts[rows[known]], counts)
        marks.append(np.stack([index.item[owner], (start - index.start[owner]) // 4, start], 1))
    found = np.concatenate(marks)
    # One of the windows that begin within four words of one another stands for them all.
    before = int(index.start.max(initial=0))
    key = found[:, 0] * (len(words) + 2 * before + 2) + found[:, 1] + before + 1
    _, lead = np.unique(key, return_index=True)
    found = found[lead]
    item, begin = found[:, 0], found[:, 1] * 4
    slack = index.edit[item] + 4
    return item, np.stack([begin - slack, found[:, 2], begin + 4 + index.size[item] + 2 * slack], 1)


def item_blocks(items: DataFrame, item_id: str, text: str, similarity: float):
    """Indexes of the items, each of texts of at most about ITEM_BYTES."""
    rows = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    size = rows.agg(F.sum(F.octet_length("t"))).head()[0] or 0
    parts = size // ITEM_BYTES + 1
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part).distinct().toArrow().sort_by([("i", "ascending"), ("t", "ascending")])
        yield Index(own.column("i").to_pylist(), own.column("t").to_pylist(), similarity)


def _marked(docs: DataFrame, sent, text: str, schema, build) -> DataFrame:
    def work(batches):
        for batch in blocks.cut(batches, text, 1 << 20):
            found = found_items(sent.value, *word_sequences(batch.column(text)))
            yield build(batch, found)

    return docs.mapInArrow(work, schema)


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, contaminated, items) of every row; ``items`` are the ids found, in order.

    Null and empty texts hold nothing; items without an id, a text or a word match nothing.
    Items that share an id count as one. Repeated rows are judged row by row.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    marked = docs.select(F.col(doc_id).alias("k"), F.col(text).alias("t"), F.array().cast("array<bigint>").alias("items"))
    for index in item_blocks(items, item_id, item_text, similarity):

        def build(batch, found):
            joined = [sorted({*a, *b}) for a, b in zip(batch.column("items").to_pylist(), found, strict=True)]
            return pa.RecordBatch.from_arrays([batch.column("k"), batch.column("t"), pa.array(joined, pa.list_(pa.int64()))], ["k", "t", "items"])

        marked = _marked(marked, docs.sparkSession.sparkContext.broadcast(index), "t", f"k {kind}, t string, items array<bigint>", build)
    return marked.select(F.col("k").alias(doc_id), (F.size("items") > 0).alias("contaminated"), "items")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    for index in item_blocks(items, item_id, item_text, similarity):
        docs = _marked(docs, docs.sparkSession.sparkContext.broadcast(index), text, docs.schema, lambda batch, found: batch.filter(pa.array([not f for f in found], pa.bool_())))
    return docs
