"""Benchmark decontamination: rare word n-grams seed candidate passages, Smith-Waterman alignment scores them.

Words are runs of word characters, lower-cased. Seeds are the ``N``-word
sequences of test items that are rare: a sequence counts as rare if its chance
under independent words, with word shares counted over the whole corpus, is at
most ``RARE``; each item keeps at least its ``LEAST`` rarest sequences, and
the ``HITS`` rarest of every ``PASSAGE`` adjacent words. Rarity is
judged by the words, not by how often the sequence occurs, so a passage that a
third of all documents copied still seeds. An item of fewer than ``N`` words is
one sequence.

A document in which ``HITS`` seeds of one item lie near each other (one, if the
item has no more) is aligned with the item there: local alignment of words,
match +2, mismatch and gap -1. The score is the best alignment's sum divided
by that of a perfect copy; a document and an item are linked from
``MIN_SCORE``, and also if the aligned passage is long by itself, whatever
share of the item it is: a sum of ``PASSAGE_SUM`` or more (13 words of which one in five was
edited) at ``PASSAGE_SHARE`` of a perfect copy's sum a word. Edited and paraphrased copies lose
score with each changed word.

Test items are the small, stated side: they are brought to the tasks in blocks
of at most ``BLOCK_WORDS`` words, one pass over the documents for each block, so
no document is shuffled and the driver holds one block at a time. Corpus
counts are taken of the items' words only.

Result: one row per linked document and item, with the best alignment's score
and its words' positions (first included, last excluded). Null or empty text
on either side: linked with nothing. Very long texts: searched whole, aligned only around seeds.
Repeated ids: their best alignment. Equal scores: the earliest. Empty tables: no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"\w+")
N, RARE, LEAST, HITS = 3, 1e-6, 8, 2
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.5
PASSAGE, PASSAGE_SUM, PASSAGE_SHARE = 13, 23, 0.7
BLOCK_WORDS = 1 << 20


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


@dataclass
class Items:
    """A block of test items: their words as numbers, and the sorted keys of their seeds."""

    ids: list
    words: list[np.ndarray]
    number: dict[str, int]
    keys: np.ndarray  # sorted; one entry per seed place
    item: np.ndarray
    place: np.ndarray
    seeds: np.ndarray  # places per item


def key_of(numbers: np.ndarray, size: int) -> np.ndarray:
    """One number per ``N`` adjacent words (all of them in fewer); numbers start at 1, 0 stands for other words."""
    n = min(N, len(numbers))
    keys = np.zeros(max(len(numbers) - n + 1, 0), dtype=np.int64)
    for k in range(n):
        keys = keys * size + numbers[k:k + len(keys)]
    return keys


def index_items(rows: list[tuple[object, str | None]], share) -> Items:
    """``share(words)`` gives each word's share of the corpus."""
    texts = [words_of(t) for _, t in rows]
    vocabulary = sorted({w for t in texts for w in t})
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    log = np.log(np.maximum(np.append(1.0, share(vocabulary)), 1e-12))
    words = [np.array([number[w] for w in t], dtype=np.int64) for t in texts]
    size = len(vocabulary) + 1
    keys, item, place = [], [], []
    for i, w in enumerate(words):
        if not len(w):
            continue
        k = key_of(w, size)
        chance = sum(log[w[j:j + len(k)]] for j in range(min(N, len(w))))
        rarest = np.argsort(chance, kind="stable")
        kept = np.union1d(rarest[:LEAST], np.flatnonzero(chance <= np.log(RARE)))
        if len(k) > (around := PASSAGE - N + 1):
            windows = np.lib.stride_tricks.sliding_window_view(chance, around)
            local = np.argsort(windows, axis=1, kind="stable")[:, :HITS] + np.arange(len(windows))[:, None]
            kept = np.union1d(kept, local.ravel())
        keys.append(k[kept] * 4 + min(N, len(w)))
        item.append(np.full(len(kept), i))
        place.append(kept)
    cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64)
    order = np.argsort(cat(keys), kind="stable")
    return Items([i for i, _ in rows], words, number, cat(keys)[order], cat(item)[order], cat(place)[order],
                 np.bincount(cat(item), minlength=len(rows)))


def align(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment: its sum and the end of its words in ``text``."""
    j = np.arange(len(text) + 1) * -GAP
    row = np.zeros(len(text) + 1, dtype=np.int64)
    best, end = 0, 0
    for w in item:
        t = np.maximum(row + GAP, 0)
        t[1:] = np.maximum(t[1:], row[:-1] + np.where(text == w, MATCH, MISMATCH))
        row = np.maximum.accumulate(t + j) - j
        at = int(row.argmax())
        if row[at] > best or (row[at] == best and at < end):
            best, end = int(row[at]), at
    return best, end


def seed_hits(numbers: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, place in the text, place in the item) of each seed found."""
    found = []
    size = len(items.number) + 1
    lengths = np.unique(items.keys % 4)
    for n in lengths:
        count = len(numbers) - n + 1
        if count <= 0:
            continue
        keys, known = np.zeros(count, dtype=np.int64), np.ones(count, dtype=bool)
        for k in range(n):
            part = numbers[k:k + count]
            known &= part > 0
            keys = keys * size + part
        at = np.flatnonzero(known)
        keys = keys[at] * 4 + n
        lo, hi = np.searchsorted(items.keys, keys, "left"), np.searchsorted(items.keys, keys, "right")
        each = hi - lo
        if each.any():
            entry = np.repeat(lo, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            found.append((items.item[entry], np.repeat(at, each), items.place[entry]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def linked(score: float, total: int, words: int, min_score: float) -> bool:
    """Whether an alignment over ``words`` words of a text links it with the item."""
    return score >= min_score or total >= PASSAGE_SUM and total >= PASSAGE_SHARE * MATCH * words


def matches(words: list[str], items: Items, min_score: float) -> list[tuple[int, float, int, int, int]]:
    """(item, score, first word, end, seeds) of each item linked with a text."""
    numbers = np.fromiter((items.number.get(w, 0) for w in words), dtype=np.int64, count=len(words))
    item, at, place = seed_hits(numbers, items)
    if not len(item):
        return []
    order = np.lexsort((at, item))
    item, at, place = item[order], at[order], place[order]
    size = np.array([len(items.words[i]) for i in item])
    cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(at) > size[1:])) + 1
    best: dict[int, tuple[float, int, int, int]] = {}
    for some in np.split(np.arange(len(item)), cuts):
        i = int(item[some[0]])
        seeds = len(np.unique(place[some]))
        if seeds < min(HITS, items.seeds[i]):
            continue
        own = items.words[i]
        lo, hi = max(0, int(at[some[0]]) - 2 * len(own)), min(len(numbers), int(at[some[-1]]) + 2 * len(own) + N)
        total, end = align(numbers[lo:hi], own)
        score = total / (MATCH * len(own))
        if score < min_score and total < PASSAGE_SUM:
            continue
        if i not in best or (-score, lo + end) < (-best[i][0], best[i][2]):
            _, back = align(numbers[lo:lo + end][::-1], own[::-1])
            if linked(score, total, back, min_score):
                best[i] = (score, lo + end - back, lo + end, seeds)
    return [(i, *v) for i, v in sorted(best.items())]


def corpus_shares(rows: DataFrame, vocabulary: set[str]):
    """A function from words of ``vocabulary`` to their shares of all words of the documents."""
    shared = rows.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches):
        total, known = 0, shared.value
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(1).to_pylist():
                w = words_of(text)
                total += len(w)
                counts.update(filter(known.__contains__, w))
        yield pa.RecordBatch.from_arrays([pa.array([None, *counts], pa.string()),
                                          pa.array([total, *counts.values()], pa.int64())], ["word", "n"])

    got = {r["word"]: r["n"] for r in rows.mapInArrow(run, "word string, n long").groupBy("word")
           .agg(F.sum("n").alias("n")).collect()}  # at most the items' words
    total = max(got.get(None, 0), 1)
    return lambda words: np.array([got.get(w, 0) / total for w in words], dtype=float)


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_words: int) -> list[DataFrame]:
    """The test items in blocks of about ``block_words`` words."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("__item")).where(F.col("__item").isNotNull())
    size = rows.agg(F.sum(F.regexp_count("__item", F.lit(r"(?U)\w+")))).first()[0] or 0
    n = int(size // block_words) + 1
    return [rows.where(F.pmod(F.xxhash64("item_id", "__item"), F.lit(n)) == k) for k in range(n)]


def decontamination(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id",
                    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """Linked documents and items: doc_id, item_id, score, first_word, last_word, n_seeds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    out = None
    for block in item_blocks(items, item_id_col, item_text_col, block_words):
        texts = [(r["item_id"], r["__item"]) for r in block.collect()]
        share = corpus_shares(rows, {w for _, t in texts for w in words_of(t)})
        found = link_block(rows, index_items(sorted(texts, key=repr), share), block.schema, min_score)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct(F.col("score"), (-F.col("last_word")).alias("e"), (-F.col("first_word")).alias("s"), "n_seeds"))
    return (out.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.score", (-F.col("b.s")).alias("first_word"),
                    (-F.col("b.e")).alias("last_word"), "b.n_seeds"))


def link_block(rows: DataFrame, items: Items, item_schema, min_score: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(items)
    kinds = [rows.schema["doc_id"].dataType.simpleString(), item_schema["item_id"].dataType.simpleString()]

    def run(batches):
        block = shared.value
        for b in batches:
            at, found = [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                got = matches(words_of(text), block, min_score) if text else []
                at += [k] * len(got)
                found += got
            if found:
                item, score, first, last, seeds = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at, pa.int64())), pa.array([block.ids[i] for i in item]),
                     pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64()),
                     pa.array(seeds, pa.int64())],
                    ["doc_id", "item_id", "score", "first_word", "last_word", "n_seeds"])

    return rows.mapInArrow(run, f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, first_word long, "
                                "last_word long, n_seeds long")
