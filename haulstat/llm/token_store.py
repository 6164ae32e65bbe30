"""Token-id store: documents as separately compressed id arrays that share one zstandard dictionary.

Layout of a store, a folder of three Parquet tables:

* ``dictionary``: one row, the zstandard dictionary and its hash;
* ``segments``: one row per segment, ``bucket`` and ``segment`` number, the
  dictionary's hash, and ``payload``: the frames of its documents one after
  another, in ascending id order;
* ``index``: one row per document: where its frame lies (bucket, segment,
  offset, length) and how many ids it holds, sorted by document, so that a
  short document is found by its id (row-group statistics) and decoded alone.

A frame is the zstandard compression of a document's ids as little-endian
unsigned integers, of two bytes if the vocabulary fits and else of four, ending
with the end id. The dictionary is trained on the serialised ids of a bounded
sample: the first 64 KiB of about ``SAMPLE`` documents chosen by a hash of their id. It only
affects sizes; every document is encoded and written whole.

Documents are encoded where they are read; only compressed frames are
shuffled, to buckets of neighbouring ids. The buckets' bounds are quantiles of
the id column, fixed before the texts are read, so encoding runs once.
Segments hold at most ``SEGMENT_BYTES`` unless one document is larger.

Tokenising: a text is cut before each space that a visible character follows
and around single line breaks; a byte-level vocabulary's splitting pattern always separates there,
so pieces can be encoded alone. A batch's texts are cut by Arrow and its pieces
numbered by a dictionary; distinct pieces not met before are encoded, the
ids of all are taken by number from a bounded table. Texts that hold one of the
tokenizer's own markers, and all texts of other kinds of tokenizers, are encoded as they are.

Null text: empty, one end id. Very long texts are encoded whole, as a slice of their own. Repeated ids: all rows kept, neighbours in
unspecified order among themselves. Null ids come first. Empty table: a store
without segments. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END = 2
SAMPLE, DICTIONARY_BYTES = 500, 64 << 10
LEVEL = 3
SEGMENT_BYTES = 1 << 20
BUCKET_BYTES = 32 << 20  # text per bucket
CACHE_PIECES = 1_500_000
SLICE_BYTES = 8 << 20  # text encoded at a time
MARKS = ".,;:!?#$%&*+-/<=>@^_|~()[]{}"  # no apostrophe: it may be one piece with letters after it
SAFE_CUT = re.compile(r" (?=\S)")
BARE = "\0"  # before a piece: it does not follow a space
#: Texts that are not cut at each space and line break: other white space, runs of it, or some at either end.
ODD_SPACE = (r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
             r"|[ \n][ \n]|\A[ \n]|[ \n]\z")

#: Commas and full stops before white space that follow neither a letter nor a digit.
ODD_MARKS = r"(\A|[^\pL\pN])[,.][ \n]"


class Pieces:
    """Known pieces, numbered, and their ids one after another."""

    def __init__(self, kind: str) -> None:
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.length = np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int64)
        self.data, self.used = np.zeros(1 << 14, dtype=self.kind), 0

    def add(self, pieces: list[str], length: np.ndarray, data: np.ndarray) -> None:
        """New pieces, each once, with their numbers of ids and these ids joined."""
        n, end = len(self.number), self.used + len(data)
        while n + len(pieces) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while end > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.number.update(zip(pieces, range(n, n + len(pieces))))
        self.length[n:n + len(pieces)] = length
        self.start[n:n + len(pieces)] = self.used + np.cumsum(length) - length
        self.data[self.used:end] = data
        self.used = end

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbered pieces' ids one after another, and where each piece's end."""
        length = self.length[numbers]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, self.used) < 1 << 31 else np.int64
        at = np.repeat((self.start[numbers] - (ends - length)).astype(kind), length)
        at += np.arange(total, dtype=kind)
        return self.data[at], ends


class Encoder:
    """Ids of whole texts as little-endian integers of ``width`` bytes."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.type = f"<u{self.width}"
        split = config.get("pre_tokenizer") or {}
        self.cuts = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                     and not config.get("normalizer"))
        self.markers = "|".join(re.escape(m) for m in [BARE, *(t["content"] for t in config.get("added_tokens") or [])])
        self.pieces = Pieces(self.type)
        self.newline = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, pieces: list[str], texts: list[str]) -> None:
        ids = self._ids(texts)
        self.pieces.add(pieces, np.array([len(x) for x in ids], dtype=np.int64),
                        np.array([i for x in ids for i in x], dtype=self.type))

    def _learn(self, new: list[str]) -> None:
        """Adds pieces.

        A piece that ends in marks after a letter is its start's ids and the marks' ids: the splitting pattern
        separates there. Starts without a line break are encoded together, one to a line, and cut at the breaks.
        """
        bare, plain, ending = {}, {}, []
        for p in new:
            if p[:1] == BARE:
                bare[p] = p[1:]
            elif "\n" in p or "\r" in p:
                bare[p] = p if p == "\n" else " " + p
            elif (start := p.rstrip(MARKS)) != p and start and start[-1].isalpha():
                marks = BARE + p[len(start):]
                ending.append((p, start, marks))
                plain[start] = None
                bare[marks] = marks[1:]
            else:
                plain[p] = None
        known = self.pieces.number
        bare = {p: t for p, t in bare.items() if p not in known}
        self._add(list(bare), list(bare.values()))
        self._learn_lines([p for p in plain if p not in known])
        if ending:
            ending = [x for x in ending if x[0] not in known]
            ids, ends = self.pieces.gather(np.array([known[x] for _, s, m in ending for x in (s, m)], dtype=np.int64))
            self.pieces.add([p for p, _, _ in ending], np.diff(ends[1::2], prepend=0), ids)

    def _learn_lines(self, plain: list[str]) -> None:
        for at in range(0, len(plain), 2000):
            some = plain[at:at + 2000]
            ids = np.array(self._ids(["".join(f" {p}\n" for p in some)])[0], dtype=self.type)
            ends = np.flatnonzero(ids == self.newline[0])
            if len(ends) != len(some) or len(self.newline) != 1:  # a piece that joins its line break
                self._add(some, [" " + p for p in some])
                continue
            self.pieces.add(some, np.diff(ends, prepend=-1) - 1, np.delete(ids, ends))

    def _joined(self, parts: pa.ListArray) -> list[bytes]:
        """Each text's ids, given its pieces: only pieces not met before are encoded, the rest is taken by number."""
        found = parts.flatten().dictionary_encode()
        names = found.dictionary.to_pylist()
        if len(self.pieces.number) + len(names) > CACHE_PIECES:
            self.pieces.clear()
        known = self.pieces.number
        numbers = [-1 if n is None else n for n in map(known.get, names)]
        number = np.array(numbers, dtype=np.int32)
        new = np.flatnonzero(number < 0).tolist()
        self._learn([names[i] for i in new])
        number[new] = [known[names[i]] for i in new]
        ids, ends = self.pieces.gather(number[found.indices.to_numpy()])
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        at = np.concatenate([[0], ends])[offsets] * self.width
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text. Texts that hold one of the tokenizer's own markers are encoded as they are, others in pieces."""
        col = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole = pc.match_substring_regex(col, self.markers) if self.cuts else pa.array([True] * len(col))
        odd = pc.and_not(pc.match_substring_regex(col, ODD_SPACE), whole)
        out: list[bytes] = [b""] * len(col)
        rest = pc.invert(pc.or_(whole, odd))
        marks = pc.and_(pc.match_substring_regex(col, ODD_MARKS), rest)  # a mark there may be one piece with what is before it
        kinds = {"whole": whole, "odd": odd, "marks": marks, "plain": pc.and_not(rest, marks)}
        for kind, mask in kinds.items():
            at = np.flatnonzero(mask.to_numpy(zero_copy_only=False))
            if not len(at):
                continue
            some = col.filter(mask)
            if kind == "whole":
                got = [np.array(x, dtype=self.type).tobytes() for x in self._ids(some.to_pylist())]
            elif kind == "odd":
                cut = [SAFE_CUT.split(t) for t in some.to_pylist()]
                got = self._joined(pa.array([[BARE + c[0], *c[1:]] for c in cut], pa.list_(pa.string())))
            else:
                marked = pc.replace_substring(some, "\n", f" \n {BARE}")
                if kind == "plain":
                    for m in ",.":
                        marked = pc.replace_substring(marked, f"{m} ", f" {BARE}{m} ")
                got = self._joined(pc.split_pattern(pc.binary_join_element_wise(BARE, marked, ""), " "))
            for i, x in zip(at.tolist(), got):
                out[i] = x
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _encoded(df: DataFrame, path: str, schema: str, make) -> DataFrame:
    """``make(id column, serialised documents)`` per batch of (id, text) rows, texts encoded in small slices."""
    def run(batches):
        enc = encoder(path)
        end = np.array([END], dtype=enc.type).tobytes()
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            at = 0
            while at < b.num_rows:  # slices of bounded text, or one text
                till = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
                part = b.slice(at, till - at)
                yield make(part.column(0), [x + end for x in enc.encode(texts.slice(at, till - at))], enc.width)
                pa.default_memory_pool().release_unused()
                at = till
    return df.mapInArrow(run, schema)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """A dictionary from about SAMPLE documents' serialised ids; empty if they are too few to train on."""
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    some = docs.where(F.pmod(F.xxhash64("__id", F.lit("dictionary")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def make(ids, raw, width):
        return pa.RecordBatch.from_arrays([pa.array([x[:1 << 16] for x in raw], pa.binary())], ["raw"])

    rows = sorted(r["raw"] for r in _encoded(some, path, "raw binary", make).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [bytes(r) for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write(df: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every row of ``df`` into a new store at ``path``."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    dictionary = train_dictionary(docs, vocabulary)
    name = xxhash.xxh3_128_hexdigest(dictionary)
    spark.createDataFrame([(name, bytearray(dictionary))], "dict_hash string, dictionary binary").coalesce(1) \
        .write.parquet(f"{path}/dictionary")
    total = docs.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n = int(total // BUCKET_BYTES) + 1
    cuts = docs.agg(F.percentile_approx("__id", [i / n for i in range(1, n)], 100 * n)).first()[0] if n > 1 else []
    cuts = sorted(set(cuts or []))
    shared = spark.sparkContext.broadcast(dictionary)
    bounds = spark.sparkContext.broadcast(cuts)  # one id per BUCKET_BYTES of text

    def make(ids, raw, width):
        c = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, **_compression(shared.value))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([c.compress(x) for x in raw], pa.binary()),
             pa.array([len(x) // width for x in raw], pa.int64()),
             pa.array([0 if i is None else bisect_left(bounds.value, i) for i in ids.to_pylist()], pa.int32())],
            ["__id", "frame", "n_tokens", "bucket"])

    kind = docs.schema["__id"].dataType.simpleString()
    frames = _encoded(docs, vocabulary, f"__id {kind}, frame binary, n_tokens long, bucket int", make)
    frames = (frames.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions("bucket", "__id"))

    def pack(batches):
        state = {"bucket": None, "segment": 0, "ids": [], "n": [], "size": [], "data": []}

        def flush():
            offset = np.concatenate([[0], np.cumsum(state["size"])[:-1]]).astype(np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array([state["bucket"]], pa.int32()), pa.array([state["segment"]], pa.int32()),
                 pa.array([name], pa.string()), pa.array([width], pa.int32()),
                 pa.array([b"".join(state["data"])], pa.binary()),
                 pa.array([state["ids"]], pa.list_(pa_id)), pa.array([offset.tolist()], pa.list_(pa.int64())),
                 pa.array([state["size"]], pa.list_(pa.int64())), pa.array([state["n"]], pa.list_(pa.int64()))],
                ["bucket", "segment", "dict_hash", "width", "payload", "ids", "offsets", "sizes", "n_tokens"])
            state.update(segment=state["segment"] + 1, ids=[], n=[], size=[], data=[])
            return out

        held = 0
        for b in batches:
            pa_id = b.column(0).type
            for i, f, n, k in zip(*(b.column(j).to_pylist() for j in range(4))):
                if state["ids"] and (k != state["bucket"] or held + len(f) > SEGMENT_BYTES):
                    yield flush()
                    held = 0
                if k != state["bucket"]:
                    state.update(bucket=k, segment=0)
                held += len(f)
                for key, v in (("ids", i), ("n", n), ("size", len(f)), ("data", f)):
                    state[key].append(v)
        if state["ids"]:
            yield flush()

    width = encoder(vocabulary).width
    packed = frames.mapInArrow(pack, f"bucket int, segment int, dict_hash string, width int, payload binary, "
                                     f"ids array<{kind}>, offsets array<long>, sizes array<long>, n_tokens array<long>")
    packed.write.option("compression", "none").parquet(f"{path}/segments")
    segments = spark.read.schema(packed.schema).parquet(f"{path}/segments")
    (segments.select("bucket", "segment", F.explode(F.arrays_zip("ids", "offsets", "sizes", "n_tokens")).alias("x"))
     .select(F.col("x.ids").alias("doc_id"), "bucket", "segment", F.col("x.offsets").alias("offset"),
             F.col("x.sizes").alias("size"), F.col("x.n_tokens").alias("n_tokens"))
     .sortWithinPartitions("bucket", "segment", "offset").write.parquet(f"{path}/index"))


def dictionary_of(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


def read(spark: SparkSession, path: str, vocabulary: str | None = None) -> DataFrame:
    """Per stored document: doc_id, bucket, segment, offset, ids (array of long)."""
    def make(ids):
        return [pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))], ["ids"]

    return _decoded(spark, path, "ids array<long>", make)


def read_one(spark: SparkSession, path: str, doc_id) -> list[int]:
    """Ids of one document, decoded alone: its index row names the segment and the bytes of its frame."""
    at = spark.read.parquet(f"{path}/index").where(F.col("doc_id") == F.lit(doc_id)).first()
    if at is None:
        raise KeyError(doc_id)
    row = (spark.read.parquet(f"{path}/segments").where((F.col("bucket") == at["bucket"]) & (F.col("segment") == at["segment"]))
           .select("width", F.substring("payload", at["offset"] + 1, at["size"]).alias("frame")).first())
    raw = zstandard.ZstdDecompressor(**_compression(dictionary_of(spark, path))).decompress(bytes(row["frame"]))
    return np.frombuffer(raw, dtype=f"<u{row['width']}").tolist()


def _decoded(spark: SparkSession, path: str, schema: str, make) -> DataFrame:
    dictionary = dictionary_of(spark, path)
    name = xxhash.xxh3_128_hexdigest(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    segments = spark.read.parquet(f"{path}/segments")

    def run(batches):
        d = zstandard.ZstdDecompressor(**_compression(shared.value))
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names}
            for i in range(b.num_rows):
                if cols["dict_hash"][i].as_py() != name:
                    raise ValueError("segment written with another dictionary")
                payload, width = memoryview(cols["payload"][i].as_py()), cols["width"][i].as_py()
                ids = cols["ids"].values.slice(cols["ids"].offsets[i].as_py(), len(cols["ids"][i]))
                at, size = cols["offsets"][i].as_py(), cols["sizes"][i].as_py()
                raw = [np.frombuffer(d.decompress(payload[o:o + s]), dtype=f"<u{width}") for o, s in zip(at, size)]
                arrays, names = make(raw)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([cols["bucket"][i].as_py()] * len(raw), pa.int32()),
                     pa.array([cols["segment"][i].as_py()] * len(raw), pa.int32()), pa.array(at, pa.int64()), *arrays],
                    ["doc_id", "bucket", "segment", "offset", *names])

    kind = segments.schema["ids"].dataType.elementType.simpleString()
    return segments.mapInArrow(run, f"doc_id {kind}, bucket int, segment int, offset long, {schema}")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document, from its decoded ids: doc_id, start (ids before it), n_tokens, ids_crc32."""
    def make(ids):
        return ([pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())], ["n_tokens", "ids_crc32"])

    docs = _decoded(spark, path, "n_tokens long, ids_crc32 long", make)
    per_segment = (spark.read.parquet(f"{path}/segments")
                   .select("bucket", "segment", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n")))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    per_bucket = per_segment.groupBy("bucket").agg(F.sum("n").alias("n"))
    bucket_start = per_bucket.select("bucket", F.coalesce(F.sum("n").over(before.orderBy("bucket")), F.lit(0))
                                     .alias("bucket_start"))  # one row per bucket
    segment_start = per_segment.select("bucket", "segment", F.coalesce(
        F.sum("n").over(before.partitionBy("bucket").orderBy("segment")), F.lit(0)).alias("segment_start"))
    starts = segment_start.join(bucket_start, "bucket")
    inside = F.coalesce(F.sum("n_tokens").over(before.partitionBy("bucket", "segment").orderBy("offset")), F.lit(0))
    return (docs.withColumn("__inside", inside).join(starts, ["bucket", "segment"])
            .select("doc_id", (F.col("bucket_start") + F.col("segment_start") + F.col("__inside")).alias("start"),
                    "n_tokens", "ids_crc32"))
