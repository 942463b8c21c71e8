"""Media columns: Ogg files in a binary column.

Writing lays packets out in pages: lacing values, granule positions, page checksums. Reading does the reverse and
trusts nothing: it verifies the checksum of every page, reassembles packets from lacing values over page borders,
demultiplexes the logical streams by serial number, checks page sequence numbers, and derives times from granule
positions. Files may be chained, and may hold any logical streams; `packets` gives those of any file. Each row is worked
on alone, so memory is bounded by the largest single file.

Defined results: null text is empty text; a null file has no streams; a file that isn't whole raises OggError in `demux`
and gives a null struct in `read_media`, unless damage is passed over: then reading goes on at the next page whose
checksum is right and leaves out packets that lack a part. Equal rows give equal files; a column that has the name of a
new one is replaced by it, any others stay; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

UNIT = 576  # bytes of a packet, one sample each
RATE = 8000  # samples a second
TAIL = 32  # bytes read back that tail_crc32 is of
AUDIO, NOTES = 0x61756469, 0x6E6F7465  # serial numbers of the two logical streams
_FLIP = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_HEAD = "<4sBBqIIIB"


class OggError(ValueError):
    """The bytes aren't a whole Ogg file."""


def checksum(page: bytes) -> int:
    """Ogg's CRC-32: polynomial 0x04C11DB7, most significant bit first, zero start, no final inversion.

    zlib has the same polynomial with mirrored bits, so bytes and result are mirrored around it.
    """
    mirrored = zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(mirrored.to_bytes(4, "little").translate(_FLIP), "big")


def lacing(length: int) -> bytes:
    """Segment lengths of a packet: 255s, then one below 255."""
    return b"\xff" * (length // 255) + bytes([length % 255])


@dataclass
class Stream:
    """Writes one logical stream's pages."""

    serial: int
    pages: list[bytes] = field(default_factory=list)

    def page(self, body: bytes, laces: bytes, granule: int, flags: int) -> None:
        head = struct.pack(_HEAD, b"OggS", 0, flags, granule, self.serial, len(self.pages), 0, len(laces)) + laces
        crc = checksum(head + body)
        self.pages.append(head[:22] + crc.to_bytes(4, "little") + head[26:] + body)

    def packets(self, packets: list[bytes], granules: list[int], last: bool) -> None:
        """Lay packets out in pages of up to 255 segments; a packet may run over a page's end."""
        laces = [lacing(len(p)) for p in packets]
        flat, body = b"".join(laces), b"".join(packets)
        ends = np.cumsum([len(x) for x in laces])
        sizes = np.frombuffer(flat, np.uint8).astype(np.int64)
        at = 0
        for i in range(0, len(flat), 255):
            j = min(i + 255, len(flat))
            done = int(np.searchsorted(ends, j, "right"))  # packets that end on this page or before
            before = int(np.searchsorted(ends, i, "right"))
            n = int(sizes[i:j].sum())
            flags = (1 if i and flat[i - 1] == 255 else 0) | (4 if last and j == len(flat) else 0)
            self.page(body[at : at + n], flat[i:j], granules[done - 1] if done > before else -1, flags)
            at += n


def mux(payload: bytes, notes: bytes = b"", rate: int = RATE, unit: int = UNIT) -> bytes:
    """An Ogg file of two logical streams: 8-bit samples in packets of `unit`, and one packet of notes."""
    audio, note = Stream(AUDIO), Stream(NOTES)
    audio.page(h := b"\x7fPCM8" + struct.pack("<II", rate, unit), lacing(len(h)), 0, 2)
    note.page(h := b"\x7fNOTE" + struct.pack("<I", len(notes)), lacing(len(h)), 0, 2)
    packets = [payload[i : i + unit] for i in range(0, len(payload), unit)]
    audio.packets(packets, np.minimum(np.arange(1, len(packets) + 1) * unit, len(payload)).tolist(), True)
    note.packets([notes], [0], True)
    first, rest = audio.pages[:1] + note.pages[:1], [audio.pages[1:], note.pages[1:]]
    longest = max(map(len, rest))
    return b"".join(first + [s[i] for i in range(longest) for s in rest if i < len(s)])


def pages(media: bytes, strict: bool = True):
    """(flags, granule, serial, number, lacing values, first byte of the body, whether bytes were passed over before) of
    each page; what isn't a whole page raises, or is passed over up to the next one."""
    at, lost = 0, False
    while at < len(media):
        why = page = None
        if len(media) - at < 27:
            why = "a page header is cut"
        else:
            magic, version, flags, granule, serial, number, crc, n = struct.unpack_from(_HEAD, media, at)
            laces = media[at + 27 : at + 27 + n]
            start = at + 27 + n
            end = start + sum(laces)
            if magic != b"OggS" or version:
                why = f"no page at {at}"
            elif len(laces) < n or end > len(media):
                why = "a page is cut"
            elif checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
                why = f"wrong checksum of the page at {at}"
            else:
                page = flags, granule, serial, number, laces, start, lost
        if page:
            yield page
            at, lost = end, False
        elif strict:
            raise OggError(why)
        else:
            at, lost = media.find(b"OggS", at + 1), True
            if at < 0:
                return


def demux(media: bytes, strict: bool = True) -> list[dict]:
    """Logical streams in the order of their first pages: serial, link of the chain, packets, granule positions (-1:
    none), number of pages, whether the stream has its end, and packets that were left out."""
    streams: list[dict] = []
    running: dict[int, dict] = {}
    link, started = 0, False
    for flags, granule, serial, number, laces, start, lost in pages(media, strict):
        s = running.get(serial)
        if flags & 2:
            if s is not None:
                if strict:
                    raise OggError("a stream begins twice")
                s = None
            if started and all(x["ended"] for x in running.values()):
                link, running = link + 1, {}
            started = False
        elif s is None and strict:
            raise OggError("a stream has no first page")
        if s is None:
            s = running[serial] = {"serial": serial, "link": link, "packets": [], "granules": [], "pages": 0, "part": b"", "next": number if not strict else 0, "ended": False, "left_out": 0, "open": False}
            streams.append(s)
        if not flags & 2:
            started = True
        gap = number != s["next"] or s["ended"]
        if gap and strict:
            raise OggError("pages are missing or out of order")
        goes_on = bool(flags & 1)
        if goes_on != s["open"] and strict:
            raise OggError("a packet's parts don't meet")
        if s["open"] and (gap or not goes_on):
            s["left_out"], s["part"], s["open"] = s["left_out"] + 1, b"", False
        headless = goes_on and not s["open"]
        ends = np.frombuffer(laces, np.uint8).astype(np.int64)
        stops = (np.cumsum(ends)[ends < 255] + start).tolist()
        before = len(s["packets"])
        for stop in stops:
            if headless:
                s["left_out"], headless = s["left_out"] + 1, False
            else:
                s["packets"].append(s["part"] + media[start:stop])
            s["part"], start = b"", stop
        s["open"] = bool(len(laces)) and laces[-1] == 255
        s["part"] = b"" if headless else s["part"] + media[start : start + int(ends[np.flatnonzero(ends < 255)[-1] + 1 :].sum() if stops else ends.sum())]
        done = len(s["packets"]) - before
        if done:
            s["granules"] += [-1] * (done - 1) + [granule]
        elif granule != -1 and not stops and strict:
            raise OggError("a granule position without a packet's end")
        s["pages"], s["next"], s["ended"] = s["pages"] + 1, number + 1, bool(flags & 4)
    if strict and any(s["open"] or not s["ended"] for s in streams):
        raise OggError("a stream has no end")
    return streams


def ends_of(granules: list[int], sizes: np.ndarray) -> np.ndarray:
    """Where each packet ends, in samples: by its page's granule position, which is that of the last packet that ends
    there, less the samples of those behind it; after the last known position, counted on."""
    known, total = np.array(granules, np.int64), np.cumsum(sizes)
    at = np.where(known >= 0, np.arange(len(known)), len(known))
    behind = np.minimum.accumulate(at[::-1])[::-1]  # the next packet with a position
    some = behind < len(known)
    out = np.array(total)
    out[some] = known[behind[some]] - (total[behind[some]] - total[some])
    if len(known) and not some.all():
        last = np.flatnonzero(known >= 0)
        if len(last):
            out[~some] = known[last[-1]] + total[~some] - total[last[-1]]
    return out


def read(media: bytes, strict: bool = True) -> dict:
    """Payload, notes, packets' times in seconds, and page counts of a file that holds one stream of samples and, maybe,
    notes, as `mux` writes them; other streams are passed over."""
    audio = note = None
    for s in demux(media, strict):
        head = s["packets"][0] if s["packets"] else b""
        if head[:5] == b"\x7fPCM8" and len(head) >= 13:
            if audio:
                raise OggError("more than one stream of samples")
            audio = s
        elif head[:5] == b"\x7fNOTE":
            note = s
    if not audio:
        raise OggError("no stream of samples")
    rate, unit = struct.unpack("<II", audio["packets"][0][5:13])
    sizes = np.array([len(p) for p in audio["packets"][1:]], np.int64)
    ends = ends_of(audio["granules"][1:], sizes)
    if strict and len(ends) and np.any(np.diff(np.concatenate([[0], ends])) != sizes):
        raise OggError("granule positions don't match the samples")
    return {"payload": b"".join(audio["packets"][1:]), "notes": b"".join(note["packets"][1:]) if note else b"", "times": ends / max(rate, 1), "rate": rate, "unit": unit, "pages": audio["pages"] + (note["pages"] if note else 0), "packets": len(sizes)}


def pad(text: bytes, unit: int = UNIT) -> bytes:
    """Bytes 255 up to a positive multiple of `unit`."""
    return text + b"\xff" * (max(1, -(-len(text) // unit)) * unit - len(text))


def feature(got: dict) -> str:
    """Duration, page and packet counts, mean level, root mean square and zero crossings of the samples read back."""
    x = np.frombuffer(got["payload"], np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"s={got['times'][-1]:.3f};pages={got['pages']};packets={got['packets']};mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};crossings={crossings}"


def store(docs: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """Add a binary column with each text's Ogg file; its notes hold the unpadded length."""

    docs = docs.drop(*[c for c in (media,) if c != text])

    def work(batches):
        for b in batches:
            files = [mux(pad(t := x or b""), len(t).to_bytes(8, "big")) for x in b.column(text).cast(pa.binary()).to_pylist()]
            yield b.append_column(media, pa.array(files, pa.binary()))

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(media, T.BinaryType())]))


READ = "struct<payload binary, notes binary, seconds double, pages long, packets long>"


def read_media(df: DataFrame, media: str = "media", out: str = "read", strict: bool = True) -> DataFrame:
    """Add what `read` finds in a binary column of files; null where a file can't be read."""
    df = df.drop(*[c for c in (out,) if c != media])
    kind = pa.struct([("payload", pa.binary()), ("notes", pa.binary()), ("seconds", pa.float64()), ("pages", pa.int64()), ("packets", pa.int64())])

    def one(x: bytes | None) -> dict | None:
        try:
            got = read(x or b"", strict)
        except OggError:
            return None
        return {"payload": got["payload"], "notes": got["notes"], "seconds": float(got["times"][-1]) if got["packets"] else 0.0, "pages": got["pages"], "packets": got["packets"]}

    def work(batches):
        for b in batches:
            for i in range(0, b.num_rows, 64):
                part = b.slice(i, 64)
                yield part.append_column(out, pa.array([one(x) for x in part.column(media).to_pylist()], kind))

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(out, T._parse_datatype_string(READ))]))


def packets(df: DataFrame, key: str, media: str = "media", strict: bool = False) -> DataFrame:
    """(key, link, serial, n, granule, packet): the packets of all logical streams of any Ogg files, one row each."""
    names = "link int, serial long, n int, granule long, packet binary"
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())

    def work(batches):
        for b in batches:
            for i, x in enumerate(b.column(1).to_pylist()):
                for s in demux(x or b"", strict):
                    rows = [(s["link"], s["serial"], n, g, p) for n, (g, p) in enumerate(zip(s["granules"], s["packets"], strict=True))]
                    for at in range(0, len(rows), 4096):
                        cols = list(zip(*rows[at : at + 4096], strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[i].as_py()] * len(cols[0]), b.column(0).type), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], [key, *(x.split()[0] for x in names.split(", "))])

    return df.select(key, media).mapInArrow(work, T.StructType([df.schema[key], *T._parse_datatype_string(names).fields]))


def digest(docs: DataFrame) -> DataFrame:
    """Store each text as Ogg, read it back through every check, and digest what was read."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pages long, n_packets long, seconds double"

    def work(batches):
        names = [x.split()[0] for x in schema.split(", ")]
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    text = text or b""
                    media = mux(pad(text), len(text).to_bytes(8, "big"))
                    got = read(media)
                    payload = got["payload"]
                    rows.append((doc, int.from_bytes(got["notes"], "big"), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-TAIL:]), len(media), hashlib.sha256(media).hexdigest(), feature(got), got["pages"], got["packets"], float(got["times"][-1])))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names)

    return docs.select("doc_id", "text").mapInArrow(work, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
