"""SentencePiece encoding that keeps the place of every piece in the original text, and decoding.

The model file is read here: its pieces, its normaliser's flags and its compiled character map, a double-array trie of byte
strings.  A text is normalised by the longest prefix that the map knows at each place, and the place of every normalised byte in
the source is recorded.  The normalised text falls apart where no piece can reach across; each distinct part is encoded once per
worker, by the library with a copy of the model that normalises nothing, and every piece is projected to bytes of the original.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.common import ship, text_or_empty

#: Fixed value: what a space becomes in a piece.
BLANK = "▁"
#: Kinds of a piece in the model file.
UNKNOWN, CONTROL, USER_DEFINED, BYTE = 2, 3, 4, 6
#: Parts of texts kept per worker; longer ones than KEPT_CHARS are encoded each time.
KEPT_PARTS, KEPT_CHARS = 400_000, 32
#: Characters encoded at a time.
BATCH_CHARS = 1 << 22


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, field as it stands) of a protocol-buffer message."""
    at = 0
    while at < len(data):
        start = at
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value, data[start:at]


class CharacterMap:
    """The compiled map: byte strings and what each becomes.  An empty one changes nothing."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = array("I", blob[4:4 + size])
        self.strings = blob[4 + size:]
        #: Two characters -> whether a known string is the first one or begins with both.
        self._matters: dict[tuple[str, str], bool] = {}

    def __bool__(self) -> bool:
        return len(self.units) > 0

    def _walk(self, data: bytes, at: int, end: int) -> tuple[int, int, bool]:
        """(length of the longest known string at ``at``, place of its value, whether the walk outlived ``end``)."""
        found, value, units = 0, 0, self.units
        step = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
        node = step(units[0])
        for i in range(at, end):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                return found, value, False
            unit = units[node]
            node ^= step(unit)
            if unit & 256:
                found, value = i + 1 - at, units[node] & 0x7FFFFFFF
        return found, value, True

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(length, replacement) of the longest known string at ``at``; length 0 if there is none."""
        found, value, _ = self._walk(data, at, len(data))
        return found, self.strings[value:self.strings.index(b"\0", value)] if found else b""

    def matters(self, first: str, second: str) -> bool:
        """Whether a known string can begin with ``first`` where ``second`` follows it."""
        known = self._matters.get((first, second))
        if known is None:
            one, both = first.encode(), (first + second).encode()
            known = self._walk(one, 0, len(one))[0] > 0 or self._walk(both, 0, len(both))[2]
            self._matters[first, second] = known
        return known


class Pieces:
    """One model file: normalised text with its alignment, ids, spans and decoded text."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as f:
            data = f.read()
        spec, trainer, self.texts, self.kinds, kept = {}, {}, [], [], []
        for number, value, whole in _fields(data):
            if number == 1:
                piece = {n: v for n, v, _ in _fields(value)}
                self.texts.append(piece.get(1, b"").decode())
                self.kinds.append(piece.get(3, 1))
            elif number == 2:
                trainer = {n: v for n, v, _ in _fields(value)}
            elif number == 3:
                spec = {n: v for n, v, _ in _fields(value)}
            elif number == 5 and any(n == 2 and v for n, v, _ in _fields(value)):
                raise ValueError("models that map characters after decoding are not supported")
            if number not in (3, 4):
                kept.append(whole)
        if BYTE not in self.kinds:
            raise ValueError("a model without byte pieces is not supported")
        if USER_DEFINED in self.kinds or trainer.get(24):
            raise ValueError("models with own symbols or with spaces behind words are not supported")
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        if not self.escape:
            raise ValueError("models that keep spaces as they are are not supported")
        self.unknown_text = trainer.get(44, " ⁇ ".encode())
        # A normaliser without a map, without a prefix, that keeps all spaces as they are.
        self.bare = SentencePieceProcessor(model_proto=b"".join(kept) + b"\x1a\x06\x18\x00\x20\x00\x28\x00")
        self.bos, self.eos = (array("I", [i] if i >= 0 else []).tobytes() for i in (self.bare.bos_id(), self.bare.eos_id()))
        plain = [t for t, k in zip(self.texts, self.kinds, strict=True) if k not in (CONTROL, UNKNOWN, BYTE)]
        self.at_blanks = not any(BLANK in t.lstrip(BLANK) for t in plain)
        self.at_lines = self.at_blanks and not any("\n" in t for t in plain)
        self._parts = re.compile(f"\n|{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+" if self.at_lines else f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        #: Part after a blank, or from a line feed on -> ids; and parts as they stand -> ids.
        self.words: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        # Bytes of the decoded text by id, and bytes of the normalised text by id.
        self.surfaces = [self._surface(t, k) for t, k in zip(self.texts, self.kinds, strict=True)]
        self.sizes = np.array([1 if k == BYTE else 0 if k == CONTROL else len(t.encode())
                               for t, k in zip(self.texts, self.kinds, strict=True)])

    def _surface(self, text: str, kind: int) -> bytes:
        if kind == CONTROL:
            return b""
        if kind == BYTE:
            return bytes([int(text[3:5], 16)])
        return self.unknown_text if kind == UNKNOWN else text.replace(BLANK, " ").encode()

    def _mapped(self, text: str, np):
        """(text after the map in UTF-8, place in the source of each of its bytes)."""
        data = text.encode()
        raw = np.frombuffer(data, np.uint8)
        begins = np.flatnonzero((raw & 0xC0) != 0x80).astype(np.int32)
        place = np.repeat(begins, np.diff(np.append(begins, len(data))))  # first byte of the character of each byte
        if not self.map or not text:
            return raw, place
        following = text[1:] + "\0"
        cared = [pair for pair in set(zip(text, following, strict=True)) if self.map.matters(*pair)]
        if not cared:
            return raw, place
        code = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        pairs = (code << 21) | np.frombuffer(following.encode("utf-32-le"), "<u4")
        parts, places, done = [], [], 0
        for at in begins[np.isin(pairs, [(ord(a) << 21) | ord(b) for a, b in cared])].tolist():
            if at < done:
                continue  # inside of what was replaced
            size, new = self.map.longest(data, at)
            if size:
                parts += [raw[done:at], np.frombuffer(new, np.uint8)]
                places += [place[done:at], np.full(len(new), at, np.int32)]
                done = at + size
        return np.concatenate([*parts, raw[done:]]), np.concatenate([*places, place[done:]])

    def normalise(self, text: str):
        """(normalised text, place in the source, in bytes, of each of its bytes and of its end)."""
        import numpy as np

        raw, place = self._mapped(text, np)
        end = len(text.encode())
        blank = raw == 32
        if self.squeeze:
            # Spaces after a space or at the start go, then those at the end.
            stay = ~(blank & np.append(True, blank[:-1])) if len(raw) else blank
            start = place[np.argmax(stay)] if stay.any() else 0
            raw, place, blank = raw[stay], place[stay], blank[stay]
            if len(raw) and blank[-1]:
                end, raw, place, blank = place[-1], raw[:-1], place[:-1], blank[:-1]
        else:
            start = 0
        if not len(raw):
            return "", np.zeros(1, np.int32)
        normal = raw.tobytes().decode().replace(" ", BLANK)
        place = np.repeat(place, np.where(blank, 3, 1))
        if self.prefix:
            normal, place = BLANK + normal, np.append(np.full(3, start, np.int32), place)
        return normal, np.append(place, np.int32(end))

    def _lookup(self, cache: dict[str, bytes], wanted: list[list[str]], whole) -> list[bytes]:
        """The ids of texts given as lists of parts."""
        new = list(dict.fromkeys(p for parts in wanted for p in parts if p not in cache))
        ids = dict(zip(new, (array("I", i).tobytes() for i in self.bare.encode([whole(p) for p in new], num_threads=1)), strict=True))
        for p in new[:max(0, KEPT_PARTS - len(cache))]:
            if len(p) <= KEPT_CHARS:
                cache[p] = ids[p]
        return [b"".join([cache.get(p) or ids[p] for p in parts]) for parts in wanted]

    def encode(self, normal: list[str]) -> list[bytes]:
        """ids of normalised texts as little-endian uint32 bytes, without begin and end."""
        quick, slow = {}, {}
        for i, text in enumerate(normal):
            if not self.at_blanks:
                slow[i] = [text] if text else []
            elif (self.at_lines and text.startswith(BLANK) and not text.endswith(BLANK)
                    and BLANK * 2 not in text and BLANK + "\n" not in text):
                quick[i] = text[1:].replace("\n", BLANK + "\n").split(BLANK)
            else:
                slow[i] = self._parts.findall(text)
        out: dict[int, bytes] = {}
        out |= zip(quick, self._lookup(self.words, list(quick.values()), lambda p: p if p[0] == "\n" else BLANK + p), strict=True)
        out |= zip(slow, self._lookup(self.others, list(slow.values()), str), strict=True)
        return [out[i] for i in range(len(normal))]

    def spans(self, ids: bytes, place):
        """(begin, end) in bytes of the source for each id; of a character in byte pieces the last one has its span."""
        import numpy as np

        sizes = self.sizes[np.frombuffer(ids, "<u4")]
        ends = np.cumsum(sizes)
        return place[ends - sizes], place[ends]

    def decode(self, ids) -> str:
        """Text of a sequence of ids, as the library gives it: bytes that are no UTF-8 become U+FFFD one by one."""
        first = 0
        while first < len(ids) and self.kinds[ids[first]] == CONTROL:
            first += 1
        parts = [self.surfaces[i] for i in ids[first:]]
        # The blank that the normaliser put before the text goes; with squeezed spaces all blanks at the start go.
        while parts and (self.prefix or self.squeeze) and self.kinds[ids[first]] != BYTE and parts[0].startswith(b" ") \
                and self.kinds[ids[first]] != UNKNOWN:
            parts[0] = parts[0][1:]
            if parts[0] or not self.squeeze:
                break
            first += 1
            del parts[0]
        try:
            return b"".join(parts).decode()
        except UnicodeDecodeError:
            return self._mended(ids[first:], parts)

    def _mended(self, ids, parts: list[bytes]) -> str:
        out, run = [], bytearray()

        def close() -> None:
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                        del run[:n]
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    del run[:1]

        for i, part in zip(ids, parts, strict=True):
            if self.kinds[i] == BYTE:
                run += part
            else:
                close()
                out.append(part.decode())
        close()
        return "".join(out)


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One model per worker process and file."""
    return Pieces(path)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def by_chars(batch, column: str = "text", limit: int = BATCH_CHARS):
    """Slices of an Arrow batch of about ``limit`` bytes of text each."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.binary_length(batch[column]).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // limit)) + 1
    bounds = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def int_lists(chunks: list):
    """An Arrow list<int32> array of numpy arrays."""
    import numpy as np
    import pyarrow as pa

    offsets = np.cumsum([0, *map(len, chunks)], dtype=np.int32)
    flat = np.concatenate(chunks) if chunks else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


#: What ``encode`` can give for a document, and its type.
OUTPUTS = {"n_tokens": "bigint", "ids": "array<int>", "begins": "array<int>", "ends": "array<int>", "ids_bytes": "binary",
           "decoded": "string", "covered_bytes": "bigint"}


def encode(docs: DataFrame, model: str | None = None, bos: bool = True, eos: bool = True,
           outputs: Sequence[str] = ("ids", "begins", "ends")) -> DataFrame:
    """One row per document: doc_id and the named ``outputs``.

    ``ids`` are those of the sentencepiece library without sampling; ``begins`` and ``ends`` are the bytes of the text in UTF-8 that
    each stands for, the end exclusive.  Begin and end ids have empty spans at the text's ends.  The first piece of a text holds
    the blank that the normaliser adds, which covers no byte.  A character in byte pieces is covered by the last of them.
    ``n_tokens`` counts the ids, ``ids_bytes`` are they as little-endian unsigned 32-bit numbers, ``decoded`` is their text as
    the library decodes them and ``covered_bytes`` the length of all spans together.

    Null and empty texts have begin and end ids alone.  Repeated rows are encoded each, null ids kept; an empty table gives no
    row.  Other columns are not read.  Texts of any length are encoded whole.
    """
    ship(docs.sparkSession)
    path = model or default_model()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = pieces(path)
        before, after = own.bos if bos else b"", own.eos if eos else b""
        for batch in (part for whole in batches for part in by_chars(whole)):
            texts = batch["text"].to_pylist()
            normal, places = zip(*map(own.normalise, texts), strict=True)
            bodies = own.encode(list(normal))
            ids = [np.frombuffer(before + b + after, "<u4") for b in bodies]
            spans = [own.spans(b, p) for b, p in zip(bodies, places, strict=True)]
            at_ends = np.zeros(len(before) // 4, np.int32), np.ones(len(after) // 4, np.int32)
            side = lambda k: int_lists([np.concatenate([at_ends[0], s[k], at_ends[1] * len(t.encode())])
                                        for s, t in zip(spans, texts, strict=True)])
            make = {
                "n_tokens": lambda: pa.array([len(i) for i in ids], pa.int64()),
                "ids": lambda: int_lists(ids),
                "begins": lambda: side(0),
                "ends": lambda: side(1),
                "ids_bytes": lambda: pa.array([i.tobytes() for i in ids], pa.binary()),
                "decoded": lambda: pa.array([own.decode(i.tolist()) for i in ids], pa.string()),
                "covered_bytes": lambda: pa.array([int((e - b).sum()) for b, e in spans], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *(make[c]() for c in outputs)], names=["doc_id", *outputs])

    schema = ", ".join(["doc_id bigint", *(f"{c} {OUTPUTS[c]}" for c in outputs)])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` (doc_id, ids) as (doc_id, text): the library's decoding of the ids; null ids have an empty text."""
    ship(encoded.sparkSession)
    path = model or default_model()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = pieces(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([own.decode(i.as_py()) for i in batch["ids"]], pa.string())], names=["doc_id", "text"])

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(run, "doc_id bigint, text string")
