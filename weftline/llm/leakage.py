"""Evaluation passages in training text: a prefix-filtered set join on shingles, verified on the words themselves.

Small edits are taken to come to at most one place for every ``RUN`` words that stand. A stretch in which m of
an item's words stand is then cut into at most m / RUN + 1 unbroken runs, so at least m - 2 (m / RUN + 1) shingles of three words
are shared with the item, whatever the edits are. ``least_places`` is this number for the least m that counts. The items' shingles are ordered
by rarity over all documents; an item's prefix leaves out its most frequent ones, up to ``LEFT_OUT`` of the number needed, so that the rest
must be met in the prefix and no pair within the bound is missed. Pairs that meet often enough go
through the length bound (the document can hold the stretch) and the positional bound (shared shingles enough
for the stretch lie within a window of the item's size and order); what is left is verified by local alignment of the words in these windows, where
the longest common subsequence, which bounds the alignment from above, allows it. The alignment finds the best stretch; it counts where ``HALF`` of the item's words
stand in it with small edits only (``EDITS``: general phrases strung together cost more), or where its score is ``SHARE``.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut, small, written

SHINGLE = 3
#: Least alignment score or share of the item's words that stand in the best stretch.
SHARE, HALF = 0.47, 0.5
#: Small edits cost at most this share of the words that match: one word in five replaced. Edits come to one place for so many words that stand.
EDITS, RUN = 0.25, 4
#: Words too many or missing that may stand between the parts of a stretch: half of the item's number, and at least so many (page headers).
SLACK = 24
#: Share of the shingles needed that the prefix may leave out.
LEFT_OUT = 0.25
#: Alignment: a match counts 1; costs of another word, of a word too many (page headers, numbers) and of a word missing.
OTHER, EXTRA, MISSING = 1.0, 0.3, 0.6
#: Up to so many documents with candidates are broadcast as ids (8 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Words of items beside which documents are verified at once; they go to every executor.
BLOCK_WORDS = 4_000_000
#: Words whose numbers a worker remembers.
REMEMBERED = 1_000_000

_SINGLE = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]")
_WORD = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]|[^\W_぀-ヿ㐀-鿿豈-﫿]+")
_SPACED, _PLAIN = re.compile(r"[^\W_]+"), re.compile(r"[a-z0-9]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words; characters where a script writes no spaces. Words cut by a hyphen at a line end are joined."""
    if not text:
        return []
    if "-\n" in text:
        text = re.sub(r"(?<=\w)-\n[ \t]*(?=[^\W\d])", "", text)
    if text.isascii():
        return _PLAIN.findall(text.lower())
    text = unicodedata.normalize("NFKC", text).lower()
    return (_WORD if _SINGLE.search(text) else _SPACED).findall(text)


class _Numbers(dict):
    """Words to whole numbers, alike in every process; what it remembers is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word) >> 1
        return number


_NUMBERS = _Numbers()


def numbered(text: str) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(_NUMBERS.__getitem__, words), dtype=np.int64, count=len(words))


def _codes(ids: np.ndarray) -> np.ndarray:
    """Code of the shingle that starts at each place."""
    n = len(ids) - SHINGLE + 1
    code = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(SHINGLE if n > 0 else 0):
        code = code * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64) + np.uint64(1)
        code ^= code >> np.uint64(29)
    return (code >> np.uint64(1)).astype(np.int64)


def least_places(n: int) -> int:
    """Of how many places of an item of ``n`` words the shingles are shared at least where enough of it stands."""
    stand = SHARE * n
    return max(1, math.ceil(stand - (SHINGLE - 1) * (stand / RUN + 1) - 1e-9))


def _least(n: Column) -> Column:
    stand = F.lit(SHARE) * n
    return F.greatest(F.lit(1), F.ceil(stand - (SHINGLE - 1) * (stand / RUN + 1) - 1e-9))


def common(item: list[int], doc: list[int], masks: dict[int, int] | None = None) -> int:
    """Length of the longest common subsequence, by bits; no alignment matches more words."""
    if masks is None:
        masks = word_masks(item)
    full = (1 << len(item)) - 1
    v = full
    for w in doc:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return len(item) - v.bit_count()


def word_masks(item: list[int]) -> dict[int, int]:
    """For each word of an item the bits of its places."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    return masks


def stretches(items: list[np.ndarray], docs: list[np.ndarray]) -> list[tuple[float, float]]:
    """Best local alignment of each item with its document: its score and how many words match in it, as shares of the item's length; of
    equal scores the one that matches more. Pairs of like widths are worked out side by side."""
    out = [(0.0, 0.0)] * len(items)
    todo = sorted((i for i in range(len(items)) if len(items[i]) and len(docs[i])), key=lambda i: (len(docs[i]), len(items[i])))
    while todo:
        rows = max(1, 60_000 // (len(docs[todo[0]]) + 1))
        part, todo = todo[:rows], todo[rows:]
        high, wide = max(len(items[i]) for i in part), max(len(docs[i]) for i in part)
        # scores are whole tenths above the bits that count the matches
        bits = 11 if high < 2000 and wide < 100_000 else 24
        kind, unit = (np.int32, 1 << 11) if bits == 11 else (np.int64, 1 << 24)
        item, doc = np.full((len(part), high), -2, dtype=np.int64), np.full((len(part), wide), -1, dtype=np.int64)
        for r, i in enumerate(part):
            item[r, : len(items[i])], doc[r, : len(docs[i])] = items[i], docs[i]
        match, other, extra, missing = (kind(x) for x in (10 * unit + 1, *(-round(10 * c) * unit for c in (OTHER, EXTRA, MISSING))))
        steps = np.arange(wide + 1, dtype=kind) * -extra
        row, new, lost = (np.zeros((len(part), wide + 1), dtype=kind) for _ in range(3))
        best = np.zeros(len(part), dtype=kind)
        for k in range(high):
            np.add(row[:, :-1], np.where(doc == item[:, k : k + 1], match, other), out=new[:, 1:])
            new[:, 0] = 0
            np.maximum(new, np.add(row, missing, out=lost), out=new)
            new += steps
            np.maximum.accumulate(new, axis=1, out=new)
            new -= steps
            np.maximum(new, 0, out=new)
            np.maximum(best, new.max(axis=1), out=best)
            row, new = new, row
        for r, i in enumerate(part):
            out[i] = (int(best[r]) // unit / 10 / len(items[i]), int(best[r]) % unit / len(items[i]))
    return out


def stretch(item: np.ndarray, doc: np.ndarray) -> tuple[float, float]:
    return stretches([item], [doc])[0]


def align(item: np.ndarray, doc: np.ndarray) -> float:
    """Best local alignment score of two word sequences, as a share of the item's length."""
    return stretch(item, doc)[0]


def _windows(pos: np.ndarray, off: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Stretches (start, end) of the document in which enough shared shingles lie, in the item's order, within a window of its size."""
    need, slack = least_places(n), max(SLACK, n // 2)
    apart = pos - off
    order = np.argsort(apart)
    apart = apart[order]
    upto = np.searchsorted(apart, apart + slack, side="right")
    starts = np.flatnonzero(upto - np.arange(len(apart)) >= need)
    if not len(starts):
        return []
    # windows that touch are one; its places are counted once
    ends = upto[starts]
    new = np.flatnonzero(starts[1:] >= ends[:-1]) + 1
    out = []
    for i, j in zip(starts[[0, *new]].tolist(), ends[[*(new - 1), -1]].tolist(), strict=True):
        if len(set(off[order[i:j]].tolist())) >= need:
            out.append((int(apart[i]) - slack // 4, int(apart[j - 1]) + n + slack // 4))
    return out


def _coded(df: DataFrame) -> DataFrame:
    """(key, n, codes): number of words and the distinct shingles of every text of (key, text), in one pass."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs = [numbered(t) for t in batch.column("text").to_pylist()]
            found = [np.unique(_codes(s)) for s in seqs]
            ends = np.cumsum([0, *map(len, found)])
            codes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([len(s) for s in seqs], pa.int32()), codes], names=["key", "n", "codes"])

    return df.select("key", "text").mapInArrow(code, "key bigint, n int, codes array<bigint>")


def _placed(items: DataFrame) -> DataFrame:
    """(nr, item, n, words, code, places): every item's distinct shingles with the number of its places, and its words as numbers."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for nr, item, text in zip(pdf["nr"], pdf["item"], pdf["text"], strict=True):
                seq = numbered(text)
                codes, places = np.unique(_codes(seq), return_counts=True)
                rows.append((nr, item, len(seq), seq, codes, places))
            yield pd.DataFrame(rows, columns=["nr", "item", "n", "words", "codes", "places"])

    return items.mapInPandas(place, "nr bigint, item bigint, n int, words array<bigint>, codes array<bigint>, places array<int>")


def leaked_items(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Rows ``(doc_id, item_id, score)``: every document with every item of which it holds enough in one stretch.

    Documents without id and null and empty texts take no part; an item of fewer than three words shares no shingle and is never found;
    repeated documents each report their items; items of the same text each do too. Texts are read whole. One pass over the documents
    finds what meets, whatever the number of items; those with candidates are verified beside the items' words, in blocks of ``BLOCK_WORDS``.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).filter("item is not null and text is not null")
    asked = cut(_placed(asked.select(F.monotonically_increasing_id().alias("nr"), "item", "text")).filter(F.size("codes") > 0))
    own = asked.select("nr", "n", F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("places").alias("places"))))
    corpus = docs.select(F.col(doc_id).alias("key"), F.col(text).alias("text")).filter("key is not null and text is not null")
    shared = _coded(corpus).select("key", "n", F.explode("codes").alias("code"))
    hits = written(shared.join(small(written(own.select("code").distinct())), "code", "left_semi"))
    # rarity over all documents, then the prefix of each item: all but its most frequent shingles
    df = hits.groupBy("code").agg(F.count(F.lit(1)).alias("df"))
    known = own.withColumn("need", _least(F.col("n"))).join(df, "code")  # what stands in no document is met by none
    behind = Window.partitionBy("nr").orderBy(F.desc("df"), F.desc("code")).rowsBetween(Window.unboundedPreceding, 0)
    left_out = F.floor(F.col("need") * LEFT_OUT)
    ranked = known.withColumn("behind", F.sum("places").over(behind))
    prefix = written(ranked.filter(F.col("behind") > left_out).select("nr", "code", F.col("n").alias("words"), "places", (F.col("need") - left_out).alias("least")))
    # the join on prefix shingles; one row per document and item that meet often enough
    met = (
        hits.join(small(prefix), "code")
        .filter(F.col("n") >= SHARE * F.col("words"))
        .groupBy("key", "nr")
        .agg(F.sum("places").alias("shared"), F.first("least").alias("least"))
        .filter(F.col("shared") >= F.col("least"))
        .groupBy("key")
        .agg(F.collect_set("nr").alias("nrs"))
    )
    met, seen = cut(met, rows=F.lit(True))
    # the documents that are left are read again: beside a broadcast of their ids where these are counted few, by shuffle beyond that
    keys = met.select("key")
    left = corpus.join(F.broadcast(keys) if seen["rows"] <= BROADCAST_ROWS else keys, "key", "left_semi").join(met, "key")
    blocks = max(1, -(-int(asked.agg(F.sum("n")).first()[0] or 0) // BLOCK_WORDS))
    if blocks > 1:
        left = cut(left)
    found = None
    for b in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("nr"), F.lit(blocks)) == b)
        told = spark.sparkContext.broadcast({r["nr"]: (r["item"], np.array(r["words"], dtype=np.int64)) for r in part.select("nr", "item", "words").toLocalIterator()})
        one = left.mapInPandas(_verifier(told), "key bigint, item bigint, score double")
        found = one if found is None else found.unionByName(one)
    return found.select(F.col("key").alias(doc_id), F.col("item").alias(item_id), "score")


def _verifier(told: Broadcast):  # noqa: ANN202
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = told.value
        codes, masks = {nr: _codes(word) for nr, (_, word) in items.items()}, {}
        for pdf in batches:
            asked = []  # (document, item, window) to be aligned
            for at_row, (nrs, text) in enumerate(zip(pdf["nrs"], pdf["text"], strict=True)):
                nrs = [nr for nr in nrs if nr in items]
                if not nrs:
                    continue
                seq = numbered(text)
                at = _codes(seq)
                order = np.argsort(at, kind="stable")
                at = at[order]
                # how many places of each item are shared, for all of them at once
                flat, sizes = np.concatenate([codes[nr] for nr in nrs]), np.array([len(codes[nr]) for nr in nrs])
                first = np.searchsorted(at, flat)
                shared = np.add.reduceat(at[np.minimum(first, len(at) - 1)] == flat, np.cumsum(sizes) - sizes) if len(at) else np.zeros(len(nrs))
                for nr, places in zip(nrs, shared.tolist(), strict=True):
                    word = items[nr][1]
                    if places >= least_places(len(word)):
                        if nr not in masks:
                            masks[nr] = word_masks(word.tolist())
                        asked.extend((at_row, nr, w) for w in windows(word, codes[nr], seq, at, order, masks[nr]))
            best: dict[tuple[int, int], tuple[float, bool]] = {}
            for (at_row, nr, _), (of, part) in zip(asked, stretches([items[nr][1] for _, nr, _ in asked], [w for *_, w in asked]), strict=True):
                score, stands = best.get((at_row, nr), (0.0, False))
                best[at_row, nr] = max(score, of), stands or of >= SHARE or (part >= HALF and of >= (1 - EDITS) * part - 1e-9)
            keys = pdf["key"].to_numpy()
            out = [(keys[at_row], items[nr][0], score) for (at_row, nr), (score, stands) in best.items() if stands]
            if out:
                yield pd.DataFrame(out, columns=["key", "item", "score"])

    return verify


def windows(word: np.ndarray, mine: np.ndarray, seq: np.ndarray, codes: np.ndarray, order: np.ndarray, masks: dict[int, int]) -> Iterator[np.ndarray]:
    """The parts of the document ``seq`` (whose shingles are ``codes``, sorted, at the places ``order``) in which enough of the item ``word`` (shingles ``mine``) may stand."""
    lo, hi = np.searchsorted(codes, mine), np.searchsorted(codes, mine, side="right")
    times = hi - lo
    off = np.repeat(np.arange(len(mine)), times)
    pos = order[np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())]
    least = min(SHARE, HALF) * len(word) - 1e-9
    for a, b in _windows(pos, off, len(word)):
        window = seq[max(a, 0) : b]
        if common(word, window.tolist(), masks) >= least:
            yield window
