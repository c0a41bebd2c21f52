"""SentencePiece encoding and decoding by a shared-prefix forward pass.

The texts of a chunk are cut into marked words (a word with the marks of the spaces before it); the
distinct ones are sorted, which lays out their trie, and walked depth-first: the forward states of
a prefix are computed once and used by all words that share it.

What a forward state holds depends on the model.  For a unigram model it is Viterbi's: the best
score up to a place and the piece that ends there.  For a merge-ranked (BPE) model the best sum of
scores is not what the model means: its result follows from the order of merges.  There, any run of
pieces in an encoding is the encoding of its own text, so each prefix has one valid last piece: the
one that, after the encoding of what is before it, merges with nothing.  That is a forward pass
over the same trie, and gives exactly the merges' result.
"""

from __future__ import annotations

import itertools
import re
from array import array
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, table, text_buffer, worker_state

MARK = "▁"  # stands for a space
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CACHED = 40 << 20  # bytes of words, and as many of pairs of pieces, that a worker remembers
ENTRY = 200        # bytes of an entry besides its text: a key, a value, their place in a table
LONG = 64          # characters of a word that is not remembered


def model_kind(path: str) -> str:
    """"unigram" or "bpe", as the model file says (its trainer's model_type); others are refused."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    kind = pb.TrainerSpec.ModelType.Name(model.trainer_spec.model_type).lower()
    if kind not in ("unigram", "bpe"):
        raise ValueError(f"pieces of a {kind} model have no merges and no scores to choose by")
    return kind


def load_vocabulary(path: str = MODEL) -> dict:
    """What the encoder needs of a model file: pieces with scores, byte pieces, the unknown's id."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(p.get_piece_size())
    special = lambda i: p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)
    return {"pieces": [p.id_to_piece(i) for i in ids], "scores": [p.get_score(i) for i in ids],
            "special": [special(i) for i in ids], "bytes": [i for i in ids if p.is_byte(i)],
            "unknown": p.unk_id(), "kind": model_kind(path)}


class Encoder:
    """Encodes and decodes with a vocabulary; remembers a bounded number of words."""

    def __init__(self, vocabulary: dict):
        self.kind = vocabulary["kind"]
        names, special = vocabulary["pieces"], vocabulary["special"]
        self.score = {s: x for s, x, odd in zip(names, vocabulary["scores"], special) if not odd}
        self.id = {s: i for i, (s, odd) in enumerate(zip(names, special)) if not odd}
        self.root: dict = {}  # trie of the vocabulary; under "" the piece that ends at a node
        for piece in self.id:
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
        self.unknown = vocabulary["unknown"]
        self.byte = {int(names[i][3:5], 16): i for i in vocabulary["bytes"]}
        raw = {i: bytes([b]) for b, i in self.byte.items()}
        self.raw = [raw.get(i, b"" if odd else s.replace(MARK, " ").encode()) for i, (s, odd) in enumerate(zip(names, special))]
        apart = "\n" if not any("\n" in s and len(s) > 1 for s in self.id) else ""
        if any(MARK in s.lstrip(MARK) for s in self.id):  # pieces that run over words: no cut but lines
            self.unit = re.compile(rf"[{apart}]|[^{apart}]+" if apart else r"(?s).+")
        else:
            self.unit = re.compile(rf"{'|'.join([apart] if apart else [])}{'|' if apart else ''}{MARK}*[^{MARK}{apart}]+|{MARK}+")
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0
        self.fits: dict[tuple[str, str], bool] = {}  # of vocabulary pieces, which are short
        self.whole: dict[str, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The merges done one by one, best score first, leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _alone(self, a: str) -> bool:
        got = self.whole.get(a)
        if got is None:
            got = self.whole[a] = len(a) == 1 or self.merged(a) == [a]
        return got

    def segmented(self, words) -> dict[str, list[str]]:
        """Pieces of each of the distinct ``words``.

        At each place of the walk are kept: the piece that ends the prefix's encoding, its score,
        and the vocabulary's pieces that are under way (where they begin, and their trie node)."""
        out, prev, best, fits = {}, "", [0.0], self.fits
        last: list[str] = [""]
        under: list[list] = [[]]
        root, bpe = self.root, self.kind == "bpe"
        floor = min(self.score.values(), default=0.0) - 10.0
        if len(fits) * ENTRY > CACHED:
            fits.clear()
        for word in sorted(words):
            n, most = 0, min(len(prev), len(word))
            while n < most and prev[n] == word[n]:
                n += 1
            del last[n + 1:], best[n + 1:], under[n + 1:]
            for i in range(n, len(word)):
                c = word[i]
                go, won, top = [], None, None
                for at in under[i]:
                    node = at[1].get(c)
                    if node is None:
                        continue
                    j = at[0]
                    go.append((j, node))
                    piece = node.get("")
                    if piece is None or won is not None and bpe:
                        continue
                    if bpe:  # one piece is valid: that which merges with nothing before it
                        if j == 0:
                            if self._alone(piece):
                                won = piece
                        else:
                            pair = (last[j], piece)
                            good = fits.get(pair)
                            if good is None:
                                good = fits[pair] = self.merged(pair[0] + piece) == [pair[0], piece]
                            if good:
                                won = piece
                    elif top is None or best[j] + self.score[piece] > top:
                        top, won = best[j] + self.score[piece], piece
                node = root.get(c)
                if node is not None:
                    go.append((i, node))
                if not bpe:
                    s = best[i] + self.score.get(c, floor)
                    if top is None or s > top:
                        top, won = s, c
                    best.append(top)
                last.append(c if won is None else won)
                under.append(go)
            prev, at, got = word, len(word), []
            while at:
                got.append(last[at])
                at -= len(last[at])
            out[word] = got[::-1]
        return out

    def _ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte:
                out += [self.byte[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of each text; a space is put before it, as the model does; of an empty text none."""
        units = [self.unit.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.known_bytes > CACHED:
            self.known.clear()
            self.known_bytes = 0
        known, long = self.known, []
        for word, pieces in self.segmented(set(itertools.chain.from_iterable(units)).difference(known)).items():
            ids = known[word] = array("i", self._ids(pieces)).tobytes()
            if len(word) > LONG:
                long.append(word)
            else:
                self.known_bytes += len(word) + len(ids) + ENTRY
        out = [np.frombuffer(b"".join(map(known.__getitem__, u)), np.int32) for u in units]
        for word in long:  # a text without spaces is one word of any length
            del known[word]
        return out

    def decode(self, ids) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def encode_texts(docs: DataFrame, vocabulary: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip) of every row of ``docs``; round_trip: decoding the
    ids gives the text again.

    The vocabulary is one model file's, a few MB whatever the input, and is broadcast.

    Nulls and odd input: null and empty texts have no ids (round_trip is true for an empty text and
    null for a null one); a character that the model lacks becomes its UTF-8 bytes; the mark
    U+2581 in a text comes back as a space, so round_trip is false; ids may be null or repeat.  An
    empty table gives no rows.  Other columns are not read, whatever their names."""
    shared = (uuid4().hex, docs.sparkSession.sparkContext.broadcast(vocabulary))

    def run(batches):
        encoder = worker_state(shared[0], lambda: Encoder(shared[1].value))
        for b in batches:
            column, (buf, off) = b.column("_t"), text_buffer(b.column("_t"))
            for i, j in chunks(off, 3 << 20, 4000):
                part = column.slice(i, j - i)
                texts = part.fill_null("").to_pylist()
                ids = encoder.encode(texts)
                same = [encoder.decode(x.tolist()) == t for x, t in zip(ids, texts)]
                n = np.array([len(x) for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays([
                    b.column("_id").slice(i, j - i), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                             pa.array(np.concatenate(ids) if ids else [], pa.int32())),
                    pa.array(same, pa.bool_(), mask=part.is_null().to_numpy(zero_copy_only=False))],
                    names=["_id", "n_tokens", "token_ids", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
    out = rows.mapInArrow(run, f"_id {kind}, n_tokens long, token_ids array<int>, round_trip boolean")
    return out.withColumnRenamed("_id", id_col)


def encode_query(spark, sf_dir: str, model: str = MODEL) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), load_vocabulary(model))
