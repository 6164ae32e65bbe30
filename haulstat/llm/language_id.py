"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

A word (a run of letters, lower-cased, with the vocabulary's word-start mark
before it) is a sequence of vocabulary pieces; each language has its own piece
probabilities. The probability of a word is the sum over *all* its
segmentations of the product of their pieces, computed by a forward pass over
the word's positions, so no segmentation has to be chosen. A text's score is
the sum of its words' log-probabilities; the prediction is the language with
the largest, and ``score`` its posterior under equal priors.

Fit: word counts of a bounded sample of training rows (``fit_rows`` expected
per language, whole texts, chosen by a hash of the id) are aggregated in Spark;
expectation-maximisation of the piece probabilities runs on these counts, whose
size the sample bounds. Held-out rows (crc32 of the id, see ``held_out``) are
never learned from; neither id, source nor language enters a prediction.

Predictions run inside ``mapInArrow``: no shuffle, texts never leave their
task. Words are scored in batches with numpy, and scores of words seen before
are kept in a bounded table per Python worker.

Defined results: null text or text without a letter: ``und`` with score 0;
no language to learn (empty table, no labelled row): ``und`` for all; repeated
rows: each predicted alike; a letter unknown to the vocabulary has one fixed
small probability in every language; letter runs of any length are summed over
all their segmentations, however long the text, those beyond ``LONGEST`` letters in a scaled pass (only the bounded
fit learns from them in parts of that length); equal scores: the first language by name;
extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.llm.common import held_out

LETTERS = re.compile(r"[^\W\d_]+")
START = "▁"  # the vocabulary's mark of a word's start
LONGEST = 40  # letters, with the mark, up to which words are scored side by side
RESCALE = 8
UNKNOWN = 1e-7
SMOOTHING = 0.05
FIT_ROWS, ROUNDS = 300, 4
CACHE_WORDS, SLICE_WORDS = 300_000, 20_000


class Steps:
    """Edges of a letter trie, stored sparsely: ``steps[node, letter]`` is the next node, 0 if there is none."""

    def __init__(self, nodes: list[dict[int, int]], n_letters: int) -> None:
        self.n_letters = n_letters
        edges = sorted((n * n_letters + c, to) for n, out in enumerate(nodes) for c, to in out.items())
        self.key = np.array([k for k, _ in edges] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.to = np.array([to for _, to in edges] + [0], dtype=np.int32)

    def __getitem__(self, at: tuple) -> np.ndarray:
        node, letter = at
        key = np.asarray(node, dtype=np.int64) * self.n_letters + letter
        found = np.searchsorted(self.key, key)
        return np.where(self.key[found] == key, self.to[found], 0)


@dataclass
class Pieces:
    """The vocabulary as a letter trie: ``step[node, letter]`` is the next node, ``piece[node]`` its piece or -1."""

    letter: dict[str, int]
    step: Steps
    piece: np.ndarray
    size: int


@lru_cache(maxsize=1)
def load_pieces(path: str) -> Pieces:
    """All pieces of a sentencepiece model that consist of lower-case letters after an optional word-start mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    texts = [t for t in texts if (b := t.removeprefix(START)) == "" and t or LETTERS.fullmatch(b) and b == b.lower()]
    letter = {c: i + 1 for i, c in enumerate(sorted({c for t in texts for c in t}))}  # 0: unknown
    nodes: list[dict[int, int]] = [{}]
    piece = [-1]
    for i, t in enumerate(texts):
        at = 0
        for c in t:
            nxt = nodes[at].get(letter[c])
            if nxt is None:
                nxt = nodes[at][letter[c]] = len(nodes)
                nodes.append({})
                piece.append(-1)
            at = nxt
        piece[at] = i
    return Pieces(letter, Steps(nodes, len(letter) + 1), np.array(piece, dtype=np.int32), len(texts))


def parts(word: str) -> list[str]:
    marked = START + word
    return [marked] if len(marked) <= LONGEST else [marked[i:i + LONGEST] for i in range(0, len(marked), LONGEST)]


def encode(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes (rows padded with 0) and lengths."""
    length = np.array([len(w) for w in words], dtype=np.int32)
    codes = np.zeros((len(words), int(length.max(initial=0))), dtype=np.int32)
    flat = np.fromiter((pieces.letter.get(c, 0) for w in words for c in w), dtype=np.int32, count=int(length.sum()))
    codes[np.arange(codes.shape[1])[None, :] < length[:, None]] = flat
    return codes, length


def arcs(codes: np.ndarray, length: np.ndarray, pieces: Pieces) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(start, end, rows, piece) for every piece that fits; piece -1 is an unknown letter. Starts ascend."""
    width = codes.shape[1]
    for start in range(width):
        rows = np.flatnonzero(length > start)
        node = np.zeros(len(rows), dtype=np.int32)
        unknown = rows[codes[rows, start] == 0]
        if len(unknown):
            yield start, start + 1, unknown, np.full(len(unknown), -1, dtype=np.int32)
        for end in range(start + 1, width + 1):
            node = pieces.step[node, codes[rows, end - 1]]
            live = node > 0
            if end > start + 1:
                live &= length[rows] >= end
            rows, node = rows[live], node[live]
            if not len(rows):
                break
            fits = pieces.piece[node] >= 0
            if fits.any():
                yield start, end, rows[fits], pieces.piece[node[fits]]


def forward(codes: np.ndarray, length: np.ndarray, probs: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Sum over all segmentations, up to every position: (rows, positions, languages). ``probs[-1]`` is UNKNOWN."""
    alpha = np.zeros((codes.shape[1] + 1, len(codes), probs.shape[1]))
    alpha[0] = 1.0
    for start, end, rows, piece in arcs(codes, length, pieces):
        alpha[end, rows] += alpha[start, rows] * probs[piece]
    return alpha


def long_score(marked: str, probs: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log-probability of one long run in each language: the same sum, scaled as it goes.

    Only the last positions that a piece can reach back to are held, as shares of a scale whose logarithm is
    kept, so a run of any length neither underflows nor takes memory beyond its own pieces.
    """
    codes = np.fromiter((pieces.letter.get(c, 0) for c in marked), dtype=np.int32, count=len(marked))
    at = np.flatnonzero(codes == 0)
    ends, starts, names = [at + 1], [at], [np.full(len(at), -1, dtype=np.int64)]
    start, node, width = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int32), 0
    while len(start):
        fits = start + width < len(codes)
        start, node = start[fits], node[fits]
        node = pieces.step[node, codes[start + width]]
        start, node, width = start[node > 0], node[node > 0], width + 1
        hit = pieces.piece[node] >= 0
        starts.append(start[hit])
        ends.append(start[hit] + width)
        names.append(pieces.piece[node[hit]].astype(np.int64))
    starts, ends, names = np.concatenate(starts), np.concatenate(ends), np.concatenate(names)
    order = np.argsort(ends, kind="stable")
    starts, names = starts[order], names[order]
    cuts = np.searchsorted(ends[order], np.arange(1, len(codes) + 2))
    window = np.zeros((width + 1, probs.shape[1]))
    window[0], scale = 1.0, np.zeros(probs.shape[1])
    lo = 0
    for end in range(1, len(codes) + 1):
        hi = cuts[end]
        now = (window[starts[lo:hi] % len(window)] * probs[names[lo:hi]]).sum(axis=0)
        window[end % len(window)] = now
        if end % RESCALE == 0:
            top = np.maximum(window.max(axis=0), 1e-300)
            window /= top
            scale += np.log(top)
        lo = hi
    return np.log(np.maximum(window[len(codes) % len(window)], 1e-300)) + scale


def word_scores(words: list[str], probs: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log-probability of each word in each language: (words, languages)."""
    out = np.zeros((len(words), probs.shape[1]))
    order = sorted((i for i in range(len(words)) if len(words[i]) < LONGEST), key=lambda i: len(words[i]))
    for at in range(0, len(order), SLICE_WORDS):
        some = order[at:at + SLICE_WORDS]
        codes, length = encode([START + words[i] for i in some], pieces)
        alpha = forward(codes, length, probs, pieces)
        out[some] = np.log(np.maximum(alpha[length, np.arange(len(some))], 1e-300))
    for i, w in enumerate(words):
        if len(w) >= LONGEST:
            out[i] = long_score(START + w, probs, pieces)
    return out


def expected_counts(codes, length, weight, probs, pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece (last: unknown letters) under one language's ``probs``: forward-backward."""
    found = list(arcs(codes, length, pieces))
    alpha = np.zeros((codes.shape[1] + 1, len(codes)))
    alpha[0] = 1.0
    for start, end, rows, piece in found:
        alpha[end, rows] += alpha[start, rows] * probs[piece]
    every = np.arange(len(codes))
    beta = np.zeros_like(alpha)
    beta[length, every] = 1.0
    total = np.maximum(alpha[length, every], 1e-300)
    counts = np.zeros(len(probs))
    for start, end, rows, piece in reversed(found):
        through = probs[piece] * beta[end, rows]
        counts += np.bincount(piece % len(probs), weights=weight[rows] / total[rows] * alpha[start, rows] * through,
                              minlength=len(probs))
        beta[start, rows] += through
    return counts


def fit_language(words: list[str], counts: list[int], pieces: Pieces, rounds: int) -> np.ndarray:
    """Piece probabilities of one language from its word counts (index -1: UNKNOWN)."""
    flat, weight = [], []
    for w, n in sorted(zip(words, counts), key=lambda x: (len(x[0]), x[0])):
        for p in parts(w):
            flat.append(p)
            weight.append(n)
    slices = [(*encode(flat[i:i + SLICE_WORDS], pieces), np.array(weight[i:i + SLICE_WORDS], dtype=float))
              for i in range(0, len(flat), SLICE_WORDS)]
    probs = np.full(pieces.size + 1, 1.0 / pieces.size)
    for _ in range(rounds):
        uses = sum(expected_counts(c, n, w, probs, pieces) for c, n, w in slices)
        uses = uses[:-1] + SMOOTHING
        probs = np.append(uses / uses.sum(), UNKNOWN)
    return probs


@dataclass
class LanguageModel:
    languages: list[str]
    probs: np.ndarray  # (pieces + 1, languages)
    vocabulary: str  # path of the vocabulary


def fit(df: DataFrame, vocabulary: str, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Piece probabilities per language, from about ``fit_rows`` training rows of each."""
    rows = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.col(lang_col).alias("__lang"))
    rows = rows.where(F.col("__text").isNotNull() & F.col("__lang").isNotNull() & ~held_out(F.col("__id")))
    share = {r["__lang"]: fit_rows / r["count"] for r in rows.groupBy("__lang").count().collect()}
    languages = sorted(share)
    pieces = load_pieces(vocabulary)
    if not languages:
        return LanguageModel([], np.zeros((pieces.size + 1, 0)), vocabulary)
    keep = F.lit(False)
    u = F.pmod(F.xxhash64("__id", F.lit("language fit")), F.lit(1 << 30)) / float(1 << 30)
    for lang in languages:
        keep = keep | ((F.col("__lang") == lang) & (u < share[lang]))

    def count_words(batches):
        for b in batches:
            got: dict[tuple[str, str], int] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in LETTERS.findall(text.lower()):
                    got[lang, w] = got.get((lang, w), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in got], pa.string()), pa.array([k[1] for k in got], pa.string()),
                 pa.array(list(got.values()), pa.int64())], ["lang", "word", "n"])

    counted = (rows.where(keep).select("__text", "__lang").mapInArrow(count_words, "lang string, word string, n long")
               .groupBy("lang", "word").agg(F.sum("n").alias("n")).groupBy("lang")
               .agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words")).collect())
    by = {r["lang"]: r["words"] for r in counted}  # bounded by the sample
    columns = [fit_language([x["word"] for x in by.get(g, [])], [x["n"] for x in by.get(g, [])], pieces, rounds)
               for g in languages]
    return LanguageModel(languages, np.stack(columns, axis=1), vocabulary)


def predict(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: doc_id, lang_pred, score."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # pieces x languages doubles: bounded by the vocabulary

    def run(batches):
        m = shared.value
        pieces = load_pieces(m.vocabulary)
        seen: dict[str, int] = {}
        scores = np.zeros((CACHE_WORDS, len(m.languages)), dtype=np.float64)
        for b in batches:
            texts = b.column(1).to_pylist()
            lang, score = [], []
            for at in range(0, len(texts), 256):
                docs = [LETTERS.findall(t.lower()) if t else [] for t in texts[at:at + 256]]
                sums = text_scores(docs, m, pieces, seen, scores)
                for words, s in zip(docs, sums):
                    if not words or not m.languages:
                        lang.append("und")
                        score.append(0.0)
                        continue
                    best = int(np.argmax(s))
                    lang.append(m.languages[best])
                    score.append(float(1.0 / np.exp(s - s[best]).sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def text_scores(docs: list[list[str]], model: LanguageModel, pieces: Pieces, seen: dict[str, int],
                scores: np.ndarray) -> np.ndarray:
    """Sum of word scores per document; ``seen`` and ``scores`` keep words already scored, within their bound."""
    flat = [w for words in docs for w in words]
    new = [w for w in set(flat) if w not in seen]
    if len(seen) + len(new) > len(scores):
        seen.clear()
        new = list(set(flat))
    extra: np.ndarray | None = None
    if len(new) > len(scores):  # more distinct words than the table holds: scored for these documents only
        seen = {w: i for i, w in enumerate(new)}
        extra = word_scores(new, model.probs, pieces)
    elif new:
        first = len(seen)
        scores[first:first + len(new)] = word_scores(new, model.probs, pieces)
        seen.update(zip(new, range(first, first + len(new))))
    out = np.zeros((len(docs), len(model.languages)))
    if flat:
        index = np.fromiter(map(seen.__getitem__, flat), dtype=np.int64, count=len(flat))
        each = (scores if extra is None else extra)[index]
        length = np.array([len(words) for words in docs])
        some = np.flatnonzero(length)
        starts = np.concatenate([[0], np.cumsum(length[some])[:-1]])
        out[some] = np.add.reduceat(each, starts, axis=0)
    return out


def language_id(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Fit on training rows of ``df`` and predict all rows: doc_id, held_out, lang_pred, score."""
    model = fit(df, vocabulary, fit_rows, ROUNDS, id_col, text_col, lang_col)
    return (predict(df, model, id_col, text_col)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))
