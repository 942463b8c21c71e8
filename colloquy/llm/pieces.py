"""SentencePiece encoding and decoding on the Tokenizers library.

The model's protobuf is parsed here, field by field. From it come the normaliser (precompiled character map, dummy
prefix, white-space rules), the metaspace marker, the vocabulary with unigram scores or BPE merges ranked by score, and
byte fallback. Batches are encoded by the library's own threads. `parity` compares ids with the sentencepiece library.

Defined results: null text encodes as empty text, empty text has no ids and decodes to empty text; null ids decode to
empty text; equal texts get equal ids; very long texts are a batch of their own; a column that has the name of a new one
is replaced by it, any others stay; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm import words

#: Where the public model lies unless a caller names another.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: A model's protobuf is sent to each Python worker; larger ones are refused.
MOST_BYTES = 64 << 20


def fields(buf: bytes):
    """(number, value) of a protobuf message: ints, raw bytes, or 4/8-byte strings."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            b = buf[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    at = 0
    while at < len(buf):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 1:
            value, at = buf[at : at + 8], at + 8
        elif kind == 2:
            n, at = varint(at)
            value, at = buf[at : at + n], at + n
        elif kind == 5:
            value, at = buf[at : at + 4], at + 4
        else:
            raise ValueError(f"protobuf wire type {kind}")
        yield key >> 3, value


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    unigram: bool = True
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_extra: bool = True
    escape: bool = True
    suffix_space: bool = False


def parse(buf: bytes) -> Model:
    """The parts of a ModelProto that encoding and decoding use."""
    m = Model()
    for number, value in fields(buf):
        if number == 1:
            p = dict(fields(value))
            m.pieces.append((p.get(1, b"").decode(), struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0], p.get(3, NORMAL)))
        elif number == 2:
            t = dict(fields(value))
            kind = t.get(3, 1)
            if kind not in (1, 2):
                raise ValueError("only unigram and BPE models are supported")
            m.unigram, m.byte_fallback, m.unk_id, m.suffix_space = kind == 1, bool(t.get(35, 0)), t.get(40, 0), bool(t.get(24, 0))
        elif number == 3:
            n = dict(fields(value))
            m.charsmap, m.dummy_prefix, m.strip_extra, m.escape = n.get(2, b""), bool(n.get(3, 1)), bool(n.get(4, 1)), bool(n.get(5, 1))
    if m.suffix_space or not m.escape:
        raise ValueError("models with a white-space suffix or bare spaces aren't supported")
    return m


def merges(m: Model) -> list[tuple[str, str]]:
    """BPE merges by falling score of what they make; of a piece's splits, those of better parts first."""
    rank = {p: i for i, (p, _, kind) in enumerate(m.pieces) if kind in (NORMAL, USER, UNUSED)}
    found = []
    for i, (p, score, kind) in enumerate(m.pieces):
        if kind == NORMAL:
            for cut in range(1, len(p)):
                if (a := p[:cut]) in rank and (b := p[cut:]) in rank:
                    found.append((-score, i, rank[a], rank[b], a, b))
    found.sort()
    return [x[4:] for x in found]


def splitter(m: Model) -> str | None:
    """A pattern whose matches no piece crosses, so that each can be encoded and cached alone.

    None if a piece has the marker after another character; a line feed that no longer piece has stands alone.
    """
    usable = [p for p, _, kind in m.pieces if kind in (NORMAL, USER)]
    if any(MARK in p.lstrip(MARK) for p in usable):
        return None
    if any("\n" in p and len(p) > 1 for p in usable):
        return f"{MARK}+[^{MARK}]*|[^{MARK}]+"
    return f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n"


def user_symbols(m: Model) -> str | None:
    """A pattern of the user-defined symbols, the longest first; these stay whole and nothing merges with them."""
    made = sorted((p for p, _, kind in m.pieces if kind == USER), key=lambda p: (-len(p), p))
    return "|".join(map(re.escape, made)) if made else None


def build(m: Model, cache: int = 20_000):
    """A Tokenizers pipeline with the model's results; user-defined symbols must be cut out before (see `Encoder`)."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if m.unigram:
        t = Tokenizer(models.Unigram([(p, s) for p, s, _ in m.pieces], m.unk_id, m.byte_fallback))
    else:
        t = Tokenizer(models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, merges(m), unk_token=m.pieces[m.unk_id][0], fuse_unk=True, byte_fallback=m.byte_fallback, cache_capacity=cache))
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.strip_extra:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    t.normalizer = normalizers.Sequence(steps)
    if pattern := splitter(m):
        t.pre_tokenizer = pre_tokenizers.Split(Regex(pattern), "isolated")
    after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    t.decoder = decoders.Sequence(after + [decoders.Strip(" ", 1, 0)] * m.dummy_prefix)
    t.encode_special_tokens = True
    return t


def load(path: str) -> bytes:
    with open(path, "rb") as f:
        buf = f.read(MOST_BYTES + 1)
    if len(buf) > MOST_BYTES:
        raise ValueError("the model is too large to send to workers")
    return buf


class Encoder:
    """Encodes batches unit by unit where no piece crosses a unit's border, and whole texts otherwise.

    A unit is a run of spaces with what follows up to the next space or line feed. Each distinct unit goes through the
    Tokenizers library once, in one multithreaded batch, and then stays in a table of bounded size; ids of texts are
    gathered from it with NumPy. Decoded bytes are gathered from the pieces and compared with the text, which also
    rules out hash collisions: a text whose bytes don't come back is encoded whole. With `check`, sentencepiece encodes
    every whole text too and must give the same ids.
    """

    def __init__(self, buf: bytes, check: bool = False, most_units: int = 1 << 19):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        # two cores a task is what a batch keeps busy; more threads would each hold memory of their own
        os.environ.setdefault("RAYON_NUM_THREADS", "2")
        self.model = m = parse(buf)
        pattern = splitter(m)
        self.symbols = user_symbols(m)
        self.by_unit = bool(pattern) and pattern.endswith("\n") and m.byte_fallback and not (m.charsmap or m.strip_extra or self.symbols) and m.dummy_prefix
        self.ref = None
        if check:
            import sentencepiece

            self.ref = sentencepiece.SentencePieceProcessor(model_proto=buf)
        if self.by_unit:
            self.bare = build(m, 0)
            self.bare.normalizer = self.bare.pre_tokenizer = None
            self.line = next(i for i, (p, _, kind) in enumerate(m.pieces) if p == "\n" or kind == BYTE and p == "<0x0A>")
        shown = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.size = np.fromiter(map(len, shown), np.int64, len(shown))
        self.at = np.cumsum(self.size) - self.size
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.most_units = most_units
        self.clear()

    @cached_property
    def whole(self):
        """The pipeline for whole texts, built when the first one needs it."""
        return build(self.model)

    def clear(self) -> None:
        """Units by rising hash: where their ids start in the pool, and how many there are."""
        self.keys = np.zeros(0, np.uint64)
        self.start, self.len = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.int32)

    def learn(self, keys: np.ndarray, units: list[str]) -> None:
        """Encode new units, many to a line-fed text since none but the line feed itself has one, and keep the ids."""
        for i in range(0, len(units), 1 << 14):
            self.learn_some(keys[i : i + (1 << 14)], units[i : i + (1 << 14)])

    def learn_some(self, keys: np.ndarray, units: list[str]) -> None:
        runs = ["\n" + "\n".join("" if u == "\n" else u for u in units[i : i + 400]) + "\n" for i in range(0, len(units), 400)]
        ids, cuts = self.cut([e.ids for e in self.bare.encode_batch_fast([r.replace(" ", MARK) for r in runs], add_special_tokens=False)])
        sizes = np.diff(cuts)
        start = len(self.pool) + cuts[:-1]
        if "\n" in units:
            i = units.index("\n")
            start[i], sizes[i] = len(self.pool) + len(ids), 1
            ids = np.append(ids, self.line).astype(np.int32)
        at = np.searchsorted(self.keys, keys)  # both rise
        self.keys, self.start, self.len = (np.insert(x, at, y) for x, y in ((self.keys, keys), (self.start, start.astype(np.int32)), (self.len, sizes.astype(np.int32))))
        self.pool = np.concatenate([self.pool, ids])

    def cut(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """The ids between line feeds, and their cuts; each list begins and ends with a line feed."""
        flat = np.concatenate([np.array(x, np.int32) for x in lists])
        feed = flat == self.line
        last = np.cumsum([len(x) for x in lists]) - 1
        owner = np.cumsum(feed)
        owner -= np.searchsorted(last, np.arange(len(flat)))  # each list has one line feed more than units
        n = int(feed.sum()) - len(lists)
        sizes = np.bincount(owner[~feed] - 1, minlength=n)
        return flat[~feed], np.concatenate([[0], np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Offsets, ids, agreement with sentencepiece (true if not asked for), and decoded texts."""
        if not self.by_unit:
            return self.encode_whole(texts)
        raw = [b" " + t.replace(MARK, " ").encode() if t else b"" for t in texts]
        offs = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(x) for x in raw], out=offs[1:])
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        space, line = data == 0x20, data == 0x0A
        first = line.copy()
        first[1:] |= line[:-1] | (space[1:] & ~space[:-1])
        first[offs[:-1][offs[:-1] < len(data)]] = True
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(data))
        unit = words.spans(data, start, end)
        keys, where, back = np.unique(unit, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most_units:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            w = where[new]
            self.learn(keys[new], [joined[a:b].decode() for a, b in zip(start[w].tolist(), end[w].tolist(), strict=True)])
        slot = np.searchsorted(self.keys, keys)[back]
        sizes = self.len[slot]
        ids = self.pool[gather(self.start[slot], sizes)]
        bound = np.searchsorted(start, offs)
        total = np.concatenate([[0], np.cumsum(sizes)])
        at = total[bound]
        same = np.ones(len(texts), bool)
        out, shown = self.bytes_of(ids)
        cuts = np.concatenate([[0], np.cumsum(shown)])[at]
        if self.ref:
            same[:] = [x == ids[i:j].tolist() for x, i, j in zip(self.ref.encode(texts, num_threads=2), at[:-1].tolist(), at[1:].tolist(), strict=True)]
        if np.array_equal(cuts, offs) and np.array_equal(out, data):
            return at, ids, same, [x[1:].decode() for x in raw]
        lists, decoded = [], []
        for i, x in enumerate(raw):
            mine = out[cuts[i] : cuts[i + 1]].tobytes()
            if mine == x:
                lists.append(ids[at[i] : at[i + 1]])
                decoded.append(x[1:].decode())
            else:  # a collision, or bytes that pieces can't show
                o, one, ok, back_text = self.encode_whole([texts[i]])
                lists.append(one)
                same[i], decoded = ok[0], decoded + back_text
        return np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64), np.concatenate([*lists, np.zeros(0, np.int32)]).astype(np.int32), same, decoded

    def encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        if self.symbols:
            lists = [self.around_symbols(t) for t in texts]
        else:
            lists = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        back = self.whole.decode_batch(lists, skip_special_tokens=False)
        same = np.ones(len(texts), bool)
        if self.ref:
            same[:] = [a == b and c == d for a, b, c, d in zip(lists, self.ref.encode(texts, num_threads=2), back, self.ref.decode(lists), strict=True)]
        return np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64), np.fromiter((x for y in lists for x in y), np.int32), same, back

    @cached_property
    def between(self):
        """The pipeline for normalised text between user-defined symbols, and the symbols' ids."""
        t = build(self.model)
        t.normalizer = None
        return t, {p: i for i, (p, _, kind) in enumerate(self.model.pieces) if kind == USER}

    def around_symbols(self, text: str) -> list[int]:
        """Ids of a text whose user-defined symbols are cut out of the normalised text first."""
        t, ids = self.between
        parts = re.split(f"({self.symbols})", self.whole.normalizer.normalize_str(text)) if text else []
        encoded = iter(t.encode_batch_fast([p for p in parts[::2]], add_special_tokens=False))
        out: list[int] = []
        for i, p in enumerate(parts):
            out += [ids[p]] if i % 2 else next(encoded).ids
        return out

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the pieces show, and the length of each."""
        sizes = self.size[ids]
        return self.shown[gather(self.at[ids], sizes)], sizes


def gather(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i] + sizes[i] - 1 of all i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - sizes), sizes)


def encode(docs: DataFrame, text: str = "text", out: str = "ids", model: str = MODEL, parity: str | None = None, decoded: str | None = None) -> DataFrame:
    """Add the ids of each text; on request the decoded text, and whether the sentencepiece library agrees."""
    buf = load(model)
    docs = docs.drop(*[c for c in (out, decoded, parity) if c and c != text])
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    schema = schema.add(decoded, "string") if decoded else schema
    schema = schema.add(parity, "boolean") if parity else schema

    def work(batches):
        coder = Encoder(buf, bool(parity))
        for b in batches:
            for part in slices(b, text):
                at, ids, same, back = coder.encode([x or "" for x in part.column(text).to_pylist()])
                part = part.append_column(out, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
                part = part.append_column(decoded, pa.array(back, pa.string())) if decoded else part
                part = part.append_column(parity, pa.array(same, pa.bool_())) if parity else part
                yield part

    return docs.mapInArrow(work, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """Add the text of each list of ids; null ids decode to empty text."""
    buf = load(model)
    df = df.drop(*[c for c in (out,) if c != ids])

    def work(batches):
        t = build(parse(buf))
        for b in batches:
            yield b.append_column(out, pa.array(t.decode_batch([x or [] for x in b.column(ids).to_pylist()], skip_special_tokens=False), pa.string()))

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def slices(b: pa.RecordBatch, text: str, most: int = 1 << 19):
    """Parts of a batch of about `most` bytes of text; a longer text is a part of its own."""
    _, offs = words.buffers(b.column(text))
    for i, j in words.chunks(offs, most):
        yield b.slice(i, j - i)


def digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: number of ids, ids, digests of ids and of the decoded text, round trip and parity."""
    buf = load(model)
    schema = "doc_id long, n_ids long, ids array<int>, ids_sha256 string, decoded_sha256 string, round_trip boolean, parity boolean"

    def work(batches):
        coder = Encoder(buf, True)
        for b in batches:
            for part in slices(b, "text"):
                texts = [x or "" for x in part.column("text").to_pylist()]
                at, ids, same, back = coder.encode(texts)
                raw = ids.astype("<i4")
                shas = [hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                cols = [part.column("doc_id"), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())), pa.array(shas, pa.string())]
                cols += [pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back], pa.string()), pa.array([x == y for x, y in zip(back, texts, strict=True)], pa.bool_()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
