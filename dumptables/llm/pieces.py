"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their log scores come from a given ``.model`` file; nothing is trained. A text
gets the whitespace marker for every blank and one in front, then the segmentation of the
highest total score; a character that no piece covers costs the lowest score less ten and is
written as its bytes. Ties go to the longer last piece, as in the reference implementation of
the format.

No piece has the marker after another character, or a line end, so the best segmentation of a
text is that of its words one after the other. Words are therefore segmented once per batch:
all starts of all new words walk the trie side by side, and the best scores are carried over
the words' positions in step. Results are kept in a dictionary of bounded size; texts are cut
at blanks into parts of about a megabyte, so memory does not grow with a text.

Nulls and edges: a null or empty text has no ids and decodes to the empty text; bytes that are
not UTF-8 are replaced first. Decoding gives back the text exactly, except that a marker
character in the text itself comes back as a blank, as the format has it.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumptables.llm.common import small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁".encode()
PART = 1 << 20
CACHED = 32 << 20  # bytes of words known, after which they are forgotten
ENTRY = 200  # of which each word takes so many beside its own
_NORMAL, _UNKNOWN, _CONTROL, _USER, _BYTE = 1, 2, 3, 4, 6  # kinds of pieces in the format
_UNKNOWN_COST = 10.0
_RUN = re.compile(rb"(?:\xe2\x96\x81)+(?:(?!\xe2\x96\x81).)*", re.DOTALL)


# --- reading the model -----------------------------------------------------------------


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value, at
            shift += 7

    at = 0
    while at < len(data):
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


@dataclass
class Vocabulary:
    """Pieces by id, and the trie of those that text can match."""

    texts: list[bytes]  # what an id decodes to
    scores: np.ndarray
    byte_ids: np.ndarray  # id of each byte's piece
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # id at the trie's node, else -1


def double_array(words: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base, check, value of a trie: from node n, byte c leads to base[n] + c if check there
    is n. The root is 0."""
    children: list[dict[int, int]] = [{}]
    ids = [-1]
    for word, number in words:
        node = 0
        for byte in word:
            step = children[node].get(byte)
            if step is None:
                step = children[node][byte] = len(children)
                children.append({})
                ids.append(-1)
            node = step
        ids[node] = number
    room = 8 * len(children) + 4096
    base, check = np.zeros(room, np.int32), np.full(room, -1, np.int32)
    value = np.full(room, -1, np.int32)
    free = np.ones(room, bool)
    free[0] = False
    place = {0: 0}
    low = 256  # the first place that may be free; no base is below one
    # Crowded nodes first, while there is room for them; each goes into the first gap it fits.
    for node in _by_crowding(children):
        own = sorted(children[node])
        while not free[low]:
            low += 1
        if len(own) == 1:
            start = low - own[0]
        else:
            start = _first_fit(free, low, np.array(own))
        at = place[node]
        base[at] = start
        for byte in own:
            child = children[node][byte]
            place[child] = start + byte
            check[start + byte] = at
            value[start + byte] = ids[child]
            free[start + byte] = False
    end = int(np.flatnonzero(~free)[-1]) + 257
    return base[:end], check[:end], value[:end]


def _first_fit(free: np.ndarray, low: int, offsets: np.ndarray) -> int:
    width = 256
    while True:
        starts = low + np.flatnonzero(free[low : low + width]) - offsets[0]
        fits = free[starts[:, None] + offsets].all(1)
        if fits.any():
            return int(starts[fits.argmax()])
        width *= 4


def _by_crowding(children: list[dict[int, int]]) -> Iterator[int]:
    """Nodes with children, parents before children, level by level, crowded ones first."""
    level = [0]
    while level:
        inner = sorted((n for n in level if children[n]), key=lambda n: -len(children[n]))
        yield from inner
        level = [c for n in inner for c in children[n].values()]


def load(path: str = MODEL) -> Vocabulary:
    with open(path, "rb") as file:
        fields = list(_fields(file.read()))
    pieces = []
    byte_fallback = False
    for number, value in fields:
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1], score, piece.get(3, _NORMAL)))
        elif number == 2:
            byte_fallback = bool(dict(_fields(value)).get(35, 0))
        elif number == 3:
            normal = dict(_fields(value))
            if normal.get(2) or not normal.get(3, 1) or normal.get(4, 1) or not normal.get(5, 1):
                raise ValueError("only models with identity normalisation and a dummy prefix")
    if not byte_fallback:
        raise ValueError("only models with byte fallback")
    texts, words = [], []
    byte_ids = np.zeros(256, np.int32)
    plain = [score for _, score, kind in pieces if kind == _NORMAL]
    scores = np.array([score for _, score, _ in pieces], np.float64)
    for number, (piece, _, kind) in enumerate(pieces):
        if kind == _BYTE:
            byte = int(piece[3:-1], 16)  # <0xNN>
            byte_ids[byte] = number
            texts.append(bytes([byte]))
        elif kind in (_NORMAL, _USER):
            if MARK in piece.lstrip(MARK) or b"\n" in piece:
                raise ValueError("only models whose pieces lie within a word")
            texts.append(piece.replace(MARK, b" "))
            words.append((piece, number))
            if kind == _USER:
                scores[number] = len(piece.decode()) * max(plain) - 0.1
        else:
            texts.append(" ⁇ ".encode() if kind == _UNKNOWN else b"")
    scores = np.append(scores, min(plain) - _UNKNOWN_COST)  # the last: an unknown character
    return Vocabulary(texts, scores, byte_ids, *double_array(words))


# --- encoding --------------------------------------------------------------------------


def _matches(flat: np.ndarray, stop: np.ndarray, v: Vocabulary):
    """(start, end, id) of all pieces in the words laid end to end, unknown characters included.

    ``stop`` is for each byte the end of its word.
    """
    starts = np.flatnonzero((flat & 0xC0) != 0x80)
    lead = flat[starts]
    width = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    alone = np.zeros(len(flat), bool)
    at, nodes, depth = starts, np.zeros(len(starts), np.int64), 0
    wide = np.zeros(len(flat), np.int64)
    wide[starts] = width
    found = []
    while len(at):
        inside = at + depth < stop[at]
        at, nodes = at[inside], nodes[inside]
        step = v.base[nodes] + flat[at + depth].astype(np.int64)
        good = v.check[step] == nodes
        at, nodes = at[good], step[good]
        depth += 1
        ids = v.value[nodes]
        hit = ids >= 0
        found.append((at[hit], np.full(int(hit.sum()), depth), ids[hit]))
        whole = at[hit & (wide[at] == depth)]
        alone[whole] = True
    bare = starts[~alone[starts]]
    found.append((bare, wide[bare], np.full(len(bare), len(v.scores) - 1)))
    begin, size, ids = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    return begin, np.minimum(begin + size, stop[begin]), ids


def segment(words: list[bytes], v: Vocabulary) -> list[tuple[int, ...]]:
    """The ids of each word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(sizes)
    first = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    begin, end, ids = _matches(flat, ends[owner], v)
    # Places between bytes: each word has one more than bytes.
    shift = owner[begin]
    start_at, end_at = begin + shift, end + shift
    best = np.full(len(flat) + len(words), -np.inf)
    best[first + np.arange(len(words))] = 0.0
    back = np.full(len(best), -1, np.int64)
    # All starts at the same distance from their word's front go together; a word has one of
    # them, so no two of their pieces end at the same place.
    offset = begin - first[shift]
    order = np.argsort(offset, kind="stable")
    cuts = np.flatnonzero(np.diff(offset[order])) + 1
    gains = v.scores[ids]
    for group in np.split(order, cuts):
        total = best[start_at[group]] + gains[group]
        better = total > best[end_at[group]]
        chosen = group[better]
        best[end_at[chosen]] = total[better]
        back[end_at[chosen]] = chosen
    return _trace(back, start_at, ids, begin, end, first, ends, flat, v)


def _trace(back, start_at, ids, begin, end, first, ends, flat, v) -> list[tuple[int, ...]]:
    """From the words' ends back to their fronts, all words a piece at a time."""
    number = np.arange(len(ends))
    at, front = ends + number, first + number
    steps, owners = [], []
    alive = np.flatnonzero(at > front)
    at = at[alive]
    while len(alive):
        piece = back[at]
        steps.append(piece)
        owners.append(alive)
        at = start_at[piece]
        inside = at > front[alive]
        at, alive = at[inside], alive[inside]
    if not steps:
        return [()] * len(ends)
    owner, piece = np.concatenate(owners), np.concatenate(steps)
    # By word, and last step first.
    order = np.lexsort((-np.arange(len(owner)), owner))
    owner, piece = owner[order], piece[order]
    found, unknown = ids[piece], len(v.scores) - 1
    odd = set(owner[found == unknown].tolist())
    cuts = np.searchsorted(owner, np.arange(len(ends) + 1)).tolist()
    flat_ids = found.tolist()
    out = [tuple(flat_ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    for k in odd:  # words with characters that are written as bytes
        whole: list[int] = []
        for m in piece[cuts[k] : cuts[k + 1]]:
            one = ids[m] != unknown
            whole += [int(ids[m])] if one else v.byte_ids[flat[begin[m] : end[m]]].tolist()
        out[k] = tuple(whole)
    return out


def parts(text: bytes) -> Iterator[bytes]:
    """``text`` cut before blanks that follow another character."""
    at = 0
    while len(text) - at > PART:
        cut = text.find(b" ", at + PART)
        while cut > 0 and text[cut - 1] == 32:
            cut = text.find(b" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def words_of(part: bytes) -> list[bytes]:
    """The words of marked text: markers first, line ends on their own."""
    out: list[bytes] = []
    for number, line in enumerate(part.split(b"\n")):
        if number:
            out.append(b"\n")
        head, *rest = line.split(MARK)
        if head:
            out.append(head)
        if b"" in rest:
            out += _RUN.findall(line, len(head))
        else:
            out += [MARK + word for word in rest]
    return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.size = 0  # bytes that the words known take, about

    def _learn(self, words: set[bytes]) -> None:
        if self.size > CACHED:
            self.known.clear()
            self.size = 0
        new = [w for w in words if w not in self.known]
        for at in range(0, len(new), 1 << 13):
            some = new[at : at + (1 << 13)]
            found = segment(some, self.vocabulary)
            self.known.update(zip(some, found, strict=True))
            self.size += sum(ENTRY + len(w) + 8 * len(f) for w, f in zip(some, found, strict=True))

    def encode(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text in turn; words are learnt for about a megabyte at a time."""
        waiting: list[tuple[list[bytes], bool]] = []  # words of a part, whether it ends a text
        size = 0
        ready: list[np.ndarray] = []
        for text in texts:
            for marked, last in _marked(text):
                waiting.append((words_of(marked), last))
                size += len(marked)
                if size > PART:
                    yield from self._flush(waiting, ready)
                    waiting, size = [], 0
        yield from self._flush(waiting, ready)

    def _flush(self, waiting, ready: list[np.ndarray]) -> Iterator[np.ndarray]:
        self._learn(set(chain.from_iterable(words for words, _ in waiting)))
        for words, last in waiting:
            ids = chain.from_iterable(map(self.known.__getitem__, words))
            ready.append(np.fromiter(ids, np.int32))
            if last:
                yield np.concatenate(ready)
                ready.clear()


def _marked(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """The parts of a text with markers for blanks, and whether each is the last."""
    try:
        text.decode()
    except UnicodeDecodeError:
        text = text.decode(errors="replace").encode()
    if not text:
        yield b"", True
        return
    before = None
    for number, part in enumerate(parts(text)):
        if before is not None:
            yield before, False
        before = part.replace(b" ", MARK)
        if not number:
            before = MARK + before
    yield before, True


def decode_ids(ids, vocabulary: Vocabulary) -> bytes:
    body = b"".join(map(vocabulary.texts.__getitem__, ids))
    return body.decode(errors="replace").encode().removeprefix(b" ")


# --- on tables ---------------------------------------------------------------------------

_ROWS = 256


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, some at a time."""
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            yield whole.slice(at, _ROWS)


def _ids_of(encoder: Encoder, texts) -> pa.ListArray:
    found = list(encoder.encode(text.as_py() or b"" for text in texts))
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))


def _texts_of(vocabulary: Vocabulary, ids) -> pa.StringArray:
    texts = []
    for one in ids:
        values = one.values
        texts.append(decode_ids(values.to_numpy().tolist() if values else (), vocabulary))
    return pa.array(texts, pa.binary()).cast(pa.string())


def _shared(df: DataFrame, path: str):
    """The vocabulary for all tasks; as large as that is."""
    return small_batches(df).sparkSession.sparkContext.broadcast(vars(load(path)))


def _bytes(docs: DataFrame) -> tuple[DataFrame, str]:
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows, docs.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, ids of every row of ``docs``."""
    shared = _shared(docs, path)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shared.value))
        for batch in _each(batches):
            ids = _ids_of(encoder, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows, kind = _bytes(docs)
    return rows.mapInArrow(make, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the text the ids stand for; null ids are none."""
    shared = _shared(encoded, path)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**shared.value)
        for batch in _each(batches):
            text = _texts_of(vocabulary, batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], ["doc_id", "ids", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(
        make, f"doc_id {kind}, ids array<int>, text string"
    )


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """What ``decode(encode(docs))`` gives, by one worker a task instead of two: ``doc_id``,
    ``ids``, and the text that is read back from the ids."""
    shared = _shared(docs, path)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(**shared.value))
        for batch in _each(batches):
            ids = _ids_of(encoder, batch.column(1))
            text = _texts_of(encoder.vocabulary, ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), ids, text], ["doc_id", "ids", "text"]
            )

    rows, kind = _bytes(docs)
    return rows.mapInArrow(make, f"doc_id {kind}, ids array<int>, text string")
