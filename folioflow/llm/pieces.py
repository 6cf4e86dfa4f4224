"""SentencePiece encoding and decoding by streaming Viterbi (operator 8).

A lattice position keeps backpointers to where its last piece began; no more positions than the longest piece has
characters can still be such a beginning. Whenever the paths back from all of them meet in one boundary, everything
before it is committed and forgotten.

For a unigram model a position keeps the piece that ends the best-scoring path. For a model of merges the score of a
path doesn't decide: there a position keeps the piece that ends the merges' own segmentation of the text up to it. A
path is that segmentation if each two neighbours, merged by themselves, give those two pieces again, so a position has
one such piece, and it is found from the positions within the window.

Where no piece of the vocabulary goes on across a boundary, all paths meet: words are encoded one by one, and what a
word gave is remembered for as long as there is room.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.llm.shared import readable, without, worker_cache

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_SPACE = "▁"
_KEEP = 1_000_000
#: Characters of a word that is kept.
_WORD = 64
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6
#: What a unigram model adds to its lowest score for an unknown character.
_UNKNOWN_PENALTY = -10.0


class Codec:
    """A model read from its file's bytes. Only models that leave the text as it is but for the marks of spaces are read."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("the model changes the text before it is encoded")
        if any(p.type not in (1, 2, 3, 5, 6) for p in proto.pieces):
            raise ValueError("the model has pieces that the user defined")
        self.prefix = _SPACE if spec.add_dummy_prefix else ""
        self.unigram = proto.trainer_spec.model_type == 1
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.scores = {p.piece: p.score for p in proto.pieces if p.type == _NORMAL}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == _UNKNOWN)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == _BYTE}
        self.penalty = min(self.scores.values(), default=0.0) + _UNKNOWN_PENALTY
        surface = {i: bytes([b]).decode("utf-8", "surrogateescape") for b, i in self.bytes.items()}
        self.texts = [p.piece if p.type == _NORMAL else surface.get(i, " ⁇ " if p.type == _UNKNOWN else "") for i, p in enumerate(proto.pieces)]
        #: Pieces that can occur: merging a piece's characters must give the piece. They are numbered from 0.
        self.texts_of = [p for p in self.ids if self.unigram or len(p) == 1 or len(self.merged(p)) == 1]
        self.numbers = [self.ids[p] for p in self.texts_of]
        self.weights = [self.scores[p] for p in self.texts_of]
        #: Pieces and their beginnings; a beginning that is no piece has -1.
        self.nodes = {p[:n]: -1 for p in self.texts_of for n in range(1, len(p))}
        self.nodes.update({p: k for k, p in enumerate(self.texts_of)})
        #: The same as nested tables of characters: (number or -1, what follows).
        self.trie: dict = {}
        for k, p in enumerate(self.texts_of):
            self._planted(p, k)
        #: For each piece, which ones merging keeps apart from it when they follow.
        self.pairs: list[dict[int, bool]] = [{} for _ in self.texts_of]
        self.n_pairs = 0
        self.known = _Words(self)
        inside = [p.lstrip(_SPACE) for p in self.ids]
        if any(_SPACE in p for p in inside):
            self.cut = None
        elif any(re.search(r"[^\W_][\W_]|[\W_][^\W_]", p) for p in inside):
            self.cut = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")
        else:
            self.cut = re.compile(rf"{_SPACE}*(?:[^\W_]+|[^{_SPACE}\w]+(?:_[^{_SPACE}\w]*)*|(?:_[^{_SPACE}\w]*)+)|{_SPACE}+")

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves: always the best-scoring pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _planted(self, piece: str, k: int) -> None:
        at = self.trie
        for c in piece[:-1]:
            at = at.setdefault(c, (-1, {}))[1]
        at[piece[-1]] = (k, at.get(piece[-1], (-1, {}))[1])

    def _apart(self, a: int, b: int) -> bool:
        """Whether merging keeps pieces a and b apart."""
        found = self.pairs[a].get(b)
        if found is None:
            if self.n_pairs > _KEEP:
                for row in self.pairs:
                    row.clear()
                self.n_pairs = 0
            left, right = self.texts_of[a], self.texts_of[b]
            found = self.pairs[a][b] = self.merged(left + right) == [left, right]
            self.n_pairs += 1
        return found

    def _letter(self, c: str) -> int:
        """A character that is no piece gets a number of its own."""
        self.nodes[c] = k = len(self.texts_of)
        self._planted(c, k)
        self.texts_of.append(c)
        self.pairs.append({})
        return k

    def short(self, text: str) -> list[int]:
        """What stream gives for a text of merges that is within one window: the paths meet at its end alone."""
        size, trie, rows, longest = len(text), self.trie, self.pairs, self.longest
        back, last = [0] * (size + 1), [-1] * (size + 1)
        for j in range(size):
            prev = last[j]
            row = rows[prev] if j else None
            i, at = j, trie
            for c in text[j : j + longest]:
                step = at.get(c)
                if step is None:
                    break
                k, at = step
                i += 1
                if k < 0 or last[i] >= 0:
                    continue
                apart = row is None or row.get(k)
                if apart is None:
                    apart = self._apart(prev, k)
                if apart:
                    back[i], last[i] = j, k
            if last[j + 1] < 0:  # no piece ends here: the character is none itself
                back[j + 1], last[j + 1] = j, self._letter(text[j])
        out = []
        while size:
            out.append(last[size])
            size = back[size]
        return out[::-1]

    def stream(self, text: str) -> Iterator[int]:
        """The pieces of text, by number, each as soon as it is sure. Holds the positions since the last common boundary."""
        size, longest, get, scores = len(text), self.longest, self.nodes.get, self.weights
        base, back, last, best = 0, [0], [-1], [0.0]  # from position base on; last is None where no path has come yet
        for j in range(size):
            here = j - base
            prev, so_far = last[here], best[here]
            end = min(size, j + longest)
            while len(last) <= end - base:
                back.append(0)
                last.append(None)
                best.append(0.0)
            for i in range(j + 1, end + 1):
                k = get(text[j:i])
                if k is None:
                    if i > j + 1:
                        break
                    k = self._letter(text[j])
                if k < 0:
                    continue
                at = i - base
                if self.unigram:
                    s = so_far + (scores[k] if k < len(scores) else self.penalty)
                    if last[at] is None or s > best[at]:
                        back[at], last[at], best[at] = j, k, s
                elif last[at] is None and (prev < 0 or self._apart(prev, k)):
                    back[at], last[at] = j, k
            if j + 1 == size or here >= 4 * longest and not j % longest:
                # The boundary nearest to the end that the paths from all positions still open have in common.
                ends = {i for i in range(j + 1, end + 1) if last[i - base] is not None} if j + 1 < size else {size}
                while len(ends) > 1:
                    top = max(ends)
                    ends.remove(top)
                    ends.add(back[top - base])
                at = meet = ends.pop()
                if meet > base:
                    out = []
                    while at > base:
                        out.append(last[at - base])
                        at = back[at - base]
                    yield from reversed(out)
                    # The piece before the boundary still decides about its neighbour.
                    keep = meet - base
                    back, last, best = back[keep:], last[keep:], best[keep:]
                    base = meet

    def pieces(self, text: str) -> list[str]:
        return [self.texts_of[k] for k in self.stream(text)]

    def _ids(self, pieces: Iterator[int]) -> Iterator[int]:
        before = False
        for k in pieces:
            known = k < len(self.numbers)
            if known:
                yield self.numbers[k]
            elif self.bytes:
                yield from (self.bytes[b] for b in self.texts_of[k].encode("utf-8"))
            elif not before:  # neighbouring unknown characters are one unknown
                yield self.unknown
            before = not known

    def encoded(self, text: str | None) -> np.ndarray:
        """The ids as whole numbers of 32 bits."""
        if not text:
            return np.zeros(0, np.int32)
        marked = self.prefix + text.replace(" ", _SPACE)
        if self.cut is None or not self.bytes:
            return np.fromiter(self._ids(self.stream(marked)), np.int32)
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.cut.findall(marked))), np.int32)

    def encode(self, text: str | None) -> list[int]:
        return self.encoded(text).tolist()

    def decode(self, ids: list[int]) -> str:
        out = "".join(map(self.texts.__getitem__, ids))
        if not out.isascii():
            try:
                out.encode()
            except UnicodeEncodeError:
                out = out.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        out = out.replace(_SPACE, " ")
        return out.removeprefix(" ") if self.prefix else out


class _Words(dict):
    """Words to the bytes of their ids; long ones aren't kept, and all are forgotten when there are too many."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        codec = self.codec
        one = codec.short if not codec.unigram and len(word) <= 4 * codec.longest else codec.stream
        found = np.fromiter(codec._ids(one(word)), np.int32).tobytes()
        if len(word) <= _WORD:
            if len(self) > _KEEP:
                self.clear()
            self[word] = found
        return found


def _codec(model: bytes) -> Codec:
    cache = worker_cache()
    if cache.get("pieces_model") != model:
        cache["pieces_model"], cache["pieces_codec"] = model, Codec(model)
    return cache["pieces_codec"]


def _encoded(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = _codec(shared.value)
    for batch in batches:
        flat, ends, same = [], [0], []
        texts = batch.column(1).to_pylist()
        for t in texts:
            ids = codec.encoded(t)
            same.append(None if t is None else codec.decode(ids.tolist()) == t)
            flat.append(ids)
            ends.append(ends[-1] + len(ids))
        null = pa.array([t is None for t in texts])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(flat) if flat else np.zeros(0, np.int32)), mask=null)
        counts = pa.array(np.diff(ends), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column(0), lists, counts, pa.array(same, pa.bool_())], names=[batch.schema.names[0], "ids", "n_ids", "restored"])


def _read(spark, model: str):
    with open(model, "rb") as f:
        return spark.sparkContext.broadcast(f.read())  # the model's file, whatever the input's size


def encode(docs: DataFrame, text: str = "text", id_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(id_col, ids, n_ids, restored) for each row of docs; restored tells whether decoding ids gives the text again.

    It does unless the text itself has the mark that stands for spaces. A null text has null ids, n_ids 0 and restored
    null; an empty one has none, and is restored. Bytes that are no UTF-8 are encoded as replacement characters. Null ids and repeated rows are carried; other columns aren't. model is
    a path on the driver. An empty table gives no rows.
    """
    columns = docs.select(F.col(f"`{id_col}`"), readable(F.col(f"`{text}`")).alias(text))
    shared = _read(docs.sparkSession, model)
    added = T._parse_datatype_string("ids array<int>, n_ids int, restored boolean").fields
    return columns.mapInArrow(lambda x: _encoded(shared, x), T.StructType([columns.schema.fields[0], *added]))


def decode(encoded: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """The rows of encoded with decoded, the text of their ids. Null ids give null, none the empty text; an id that the
    model doesn't have is an error. A column named decoded, in any case of letters, is replaced."""
    encoded = without(encoded, "decoded")
    shared = _read(encoded.sparkSession, model)

    @F.pandas_udf("string")
    def texts(rows):
        codec = _codec(shared.value)
        return rows.map(lambda x: None if x is None else codec.decode(x.tolist()))

    return encoded.withColumn("decoded", texts(F.col(f"`{ids}`")))
