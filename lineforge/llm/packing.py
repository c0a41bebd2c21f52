"""Packing of tokenised documents into training sequences, with bounded-space online best-fit.

A task reads its documents once, tokenises them and places the pieces at once: a fixed number of
windows is open, a piece goes where it leaves the least room, and where none has room the fullest
window is closed and a new one opened.  What is open when a partition ends (a bounded number of
windows) is merged: sixteen partitions' leftovers at a time are packed together, largest first,
and what is left of them goes to the next round, until one group is left.  No task ever holds more
than its own open windows, or sixteen times as many in a merge, whatever the input's size.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, table, text_buffer

SIZE = 2048      # tokens of a sequence
OPEN = 64        # windows that a partition holds open
MAX_GAP = 64     # a window is closed with this padding at most: where it has more room, a piece is cut
FAN_IN = 16      # partitions whose leftovers are merged at a time
END = 1          # id after each document
GROUPS = 1 << 28  # partitions that a sequence id can name


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Text of a public tokenizer's file (a few MB whatever the input)."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def _byte_names() -> dict[str, int]:
    """How byte-level vocabularies write the bytes: printable ones as themselves, the others as the
    characters from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizer:
    """The ids that the ``tokenizers`` library gives (``add_special_tokens=False``).

    Where the file is a plain byte-level BPE with ids in the order of its merges, a rank-based
    encoder for the same vocabulary gives the same ids several times faster; texts that it refuses
    (its pattern has a depth limit on millions of spaces), and all texts of other files, go to the
    library itself."""

    def __init__(self, text: str):
        self.text, self.library = text, None
        self.fast = self._ranked(json.loads(text))

    @staticmethod
    def _ranked(spec: dict):
        import public_tokenizers
        import tiktoken

        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                 and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("ignore_merges")
                 and all(model.get(k) in (None, "") for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
                 and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
        if not plain:
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranks = [model["vocab"][a + b] for a, b in pairs]
        if ranks != sorted(set(ranks)):
            return None
        name = _byte_names()
        extra = {t["content"]: t["id"] for t in spec["added_tokens"]}
        raw = {bytes(name[c] for c in s): i for s, i in model["vocab"].items() if s not in extra}
        return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=raw, special_tokens=extra)

    def _slow(self, text: str) -> np.ndarray:
        import tokenizers

        if self.library is None:
            self.library = tokenizers.Tokenizer.from_str(self.text)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)
            except ValueError:
                pass
        return self._slow(text)


@lru_cache(1)
def _tokenizer(text: str) -> Tokenizer:
    """The worker's tokenizer, over its tasks: of one vocabulary."""
    return Tokenizer(text)


class Piece:
    """Ids of a document from ``start`` on, which lie together."""
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc, self.start, self.ids[:n], self.total),
                Piece(self.doc, self.start + n, self.ids[n:], self.total))


class OpenWindows:
    """At most ``most`` open windows; pieces are placed one after the other."""

    def __init__(self, size: int, most: int, max_gap: int):
        self.size, self.most, self.max_gap = size, most, max_gap
        self.windows: dict[int, list[Piece]] = {}
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.next = 0

    def place(self, piece: Piece):
        """Yields the windows that are closed by it."""
        while len(piece.ids) >= self.size:
            full, piece = piece.cut(self.size)
            yield [full]
        while len(piece.ids):
            n = len(piece.ids)
            at = bisect_left(self.rooms, (n, -1))
            if at < len(self.rooms):  # the least room that is enough
                room, w = self.rooms.pop(at)
                self.windows[w].append(piece)
                if room == n:
                    yield self.windows.pop(w)
                else:
                    insort(self.rooms, (room - n, w))
                return
            if len(self.rooms) == self.most:  # none has room: the fullest is closed
                room, w = self.rooms.pop(0)
                closed = self.windows.pop(w)
                if room > self.max_gap:
                    head, piece = piece.cut(room)
                    closed.append(head)
                    n = len(piece.ids)
                yield closed
            self.windows[self.next] = [piece]
            insort(self.rooms, (self.size - n, self.next))
            self.next += 1
            return


def merge_windows(pieces: list[Piece], size: int, carry: int, max_gap: int) -> tuple[list, list]:
    """(closed windows, open windows): the pieces packed best-fit, largest first.

    Of the windows with more room than ``max_gap`` the ``carry`` emptiest stay open; the others are
    filled up with pieces cut from the emptiest of them.  The one that this leaves half full stays
    open too, and is closed only if ``carry`` is 0."""
    packer = OpenWindows(size, len(pieces) + 1, 0)
    closed = []
    for p in sorted(pieces, key=lambda p: (-len(p.ids), p.start, p.total, p.ids.tobytes())):
        closed += packer.place(p)
    rest = [(room, packer.windows[w]) for room, w in packer.rooms]
    closed += [w for room, w in rest if room <= max_gap]
    rest = [x for x in rest if x[0] > max_gap]  # in order of room
    cut = max(len(rest) - carry, 0)
    kept, rest = [w for _, w in rest[cut:]], [[room, w] for room, w in rest[:cut]]
    i, j = 0, len(rest) - 1
    while i < j:
        room, w = rest[i]
        if room <= max_gap:
            closed.append(w)
            i += 1
            continue
        piece = rest[j][1].pop()
        if len(piece.ids) > room:
            piece, back = piece.cut(room)
            rest[j][1].append(back)
        w.append(piece)
        rest[i][0] -= len(piece.ids)
        if not rest[j][1]:
            j -= 1
    if i == j:
        (kept if carry else closed).append(rest[i][1])
    return closed, kept


def _rows(windows, first: int | None, part: int, doc_type: pa.DataType) -> pa.RecordBatch:
    """A row for each piece; first: id of the first window, none for windows that stay open."""
    cols: dict[str, list] = {k: [] for k in ("_id", "start", "ids", "doc_tokens", "sequence_id", "offset")}
    for k, w in enumerate(windows):
        at = 0
        for p in w:
            for name, x in zip(cols, (p.doc, p.start, p.ids.astype("<u4").tobytes(), p.total,
                                      None if first is None else first + k, None if first is None else at)):
                cols[name].append(x)
            at += len(p.ids)
    kinds = (doc_type, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    arrays = [pa.array(x, t) for x, t in zip(cols.values(), kinds)]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(cols["_id"]), pa.int64())], names=[*cols, "part"])


def _merged(size: int, carry: int, max_gap: int, turn: int):
    """What a merge round does with the leftovers of a group of partitions."""
    def merged(key, t):
        cols = [t.column(n).to_pylist() for n in ("_id", "start", "ids", "doc_tokens")]
        pieces = [Piece(d, s, np.frombuffer(i, "<u4"), n) for d, s, i, n in zip(*cols)]
        part, doc_type = key[0].as_py(), t.schema.field("_id").type
        closed, kept = merge_windows(pieces, size, carry, max_gap)
        return pa.Table.from_batches([_rows(closed, (turn << 60) + (part << 32), part, doc_type),
                                      _rows(kept, None, part, doc_type)])
    return merged


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, open_windows: int = OPEN, max_gap: int = MAX_GAP,
         end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, ids, doc_tokens, sequence_id, offset) of every piece of every row of ``docs``.

    A document's ids (the tokenizer's, then ``end``) are cut at multiples of ``size``; what is left
    is placed whole where a window has room, else where the fullest one would be closed with more
    than ``max_gap`` tokens of padding, it is cut there.  So no sequence but the last has more
    padding.  ids: little-endian unsigned 32-bit numbers; offset: the piece's place in its sequence.
    ``tokenizer`` is the text of a tokenizer file (:func:`tokenizer_file`).

    Nulls and odd input: a null or empty text is the end id alone; a text of any length is cut, and
    encoded whole before; null and repeated ids and equal rows are packed row by row.  An empty
    table gives no rows.  Other columns are not read, whatever their names.  Rows of one partition
    are placed in their order; sequence ids are unique, not gapless."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    schema = f"_id {kind}, start long, ids binary, doc_tokens long, sequence_id long, offset long, part long"

    def placed(batches):
        tok, packer, part = _tokenizer(shared.value), OpenWindows(size, open_windows, max_gap), TaskContext.get().partitionId()
        n, doc_type = 0, None
        for b in batches:
            names, texts = b.column("_id"), b.column("_t")
            doc_type = names.type
            _, off = text_buffer(texts)
            for i, j in chunks(off, 1 << 20, 1000):
                closed = []
                for doc, text in zip(names.slice(i, j - i).to_pylist(), texts.slice(i, j - i).to_pylist()):
                    ids = np.append(tok.ids(text), np.uint32(end)) if text else np.array([end], np.uint32)
                    closed += packer.place(Piece(doc, 0, ids, len(ids)))
                if closed:
                    yield _rows(closed, (part << 32) + n, part, doc_type)
                    n += len(closed)
        if packer.windows:
            yield _rows(packer.windows.values(), None, part, doc_type)

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    done = materialise(rows.mapInArrow(placed, schema), "packed")
    out, left = done.where("sequence_id is not null"), done.where("sequence_id is null")
    parts, turn = left.agg(F.max("part")).first()[0], 0
    while parts is not None:
        last, turn = parts < FAN_IN, turn + 1

        merged = _merged(size, 0 if last else open_windows, max_gap, turn)
        done = materialise(left.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("part").applyInArrow(merged, schema),
                           "packed")
        out, left = out.unionByName(done.where("sequence_id is not null")), done.where("sequence_id is null")
        parts = None if last else parts // FAN_IN
    return out.drop("part").withColumnRenamed("_id", id_col)


def sequences(pieces: DataFrame, size: int = SIZE, pad: int = 0, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, n_tokens, ids, documents): the training rows that the pieces of :func:`pack`
    make, each of ``size`` little-endian 32-bit ids, filled up with ``pad``; documents: the pieces'
    doc_id, start, offset and length, for attention masks."""
    part = F.struct("offset", "ids", F.col(id_col).alias("doc"), "start", (F.octet_length("ids") / 4).cast("long").alias("length"))
    rows = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    total = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    # shift of the padding: 4 bytes an id, little-endian
    filled = F.concat("ids", F.expr(f"unhex(repeat('{int(pad).to_bytes(4, 'little').hex()}', cast({size} - n_tokens as int)))"))
    docs = F.transform("p", lambda x: F.struct(x["doc"].alias("doc_id"), x["start"].alias("start"), x["offset"].alias("offset"),
                                               x["length"].alias("length")))
    return (rows.select("sequence_id", total.alias("n_tokens"), joined.alias("ids"), docs.alias("documents"))
            .withColumn("ids", filled))


def packing_query(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
