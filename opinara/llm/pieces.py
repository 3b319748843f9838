"""SentencePiece encoding and decoding by shared-prefix Viterbi.

Words are marked (the space before a word becomes U+2581) and no piece crosses a mark that follows a letter, so a text's
ids are those of its marked words.  The distinct words of a batch are sorted, which walks their trie depth first: the
forward states of a word's prefix are kept from the word before.  A state is the best path to that prefix: its score
and its last piece.

For a merge model (BPE) a path is allowed only if merging would leave each two neighbouring pieces as they are.  Exactly one
path is allowed then and it is what merging gives; for a unigram model every path is allowed and the best score wins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

MARK = "▁"
CACHE = 300_000  # words whose ids a task remembers
PAIRS = 400_000  # pairs of pieces whose verdict it remembers
MISSING = object()


class Vocabulary:
    """Pieces, scores and ids; ``merges`` tells a merge model from a unigram model."""

    def __init__(self, scores: dict[str, float], ids: dict[str, int], byte_ids: list[int], merges: bool) -> None:
        self.scores, self.ids, self.byte_ids, self.merges = scores, ids, byte_ids, merges
        #: Every end of a piece, with its score if it is a piece itself.
        self.tails: dict[str, float | None] = {p[i:]: None for p in scores for i in range(len(p))} | scores
        self.unknown = min(scores.values(), default=0.0) - 10
        self.pairs: dict[tuple[str, str], bool] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        plain = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
        found = {model.id_to_piece(i): i for i in plain}
        own = [i for i in range(model.vocab_size()) if model.is_byte(i)]
        scores = {p: model.get_score(i) for p, i in found.items()}
        # a merge model scores its pieces by their rank, a unigram model by their log probability
        return cls(scores, found, own, merges=all(score.is_integer() for score in scores.values()))

    def merged(self, text: str) -> list[str]:
        """What merging the best neighbours, leftmost first, gives: for short strings."""
        parts = list(text)
        while len(parts) > 1:
            best = max(((self.scores.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1)))
            if best[0] == -np.inf:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, last: str, piece: str) -> bool:
        """Whether ``piece`` may come after ``last`` ('' at the start)."""
        known = self.merged(last + piece) == ([last, piece] if last else [piece])
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        self.pairs[last, piece] = known
        return known

    def id_list(self, piece: str) -> list[int]:
        own = self.ids.get(piece)
        return [own] if own is not None else [self.byte_ids[b] for b in piece.encode()]


State = tuple[float, int, str]  # score, length of the last piece, the last piece


def next_state(states: list[State], word: str, n: int, vocabulary: Vocabulary) -> State:
    """The best path to the first ``n`` characters of ``word`` from the paths to fewer of them."""
    tails, pairs, merges = vocabulary.tails, vocabulary.pairs, vocabulary.merges
    best: State | None = None
    for start in range(n - 1, -1, -1):
        piece = word[start:n]
        score = tails.get(piece, MISSING)
        if score is MISSING:  # no piece ends like this
            if best is None and start == n - 1:
                best = (states[start][0] + vocabulary.unknown, 1, piece)
            break
        if score is None:  # the end of a piece but none itself
            continue
        before, _, last = states[start]
        if merges:
            allowed = pairs.get((last, piece))
            if allowed or allowed is None and vocabulary.follows(last, piece):
                return before + score, n - start, piece
        elif best is None or before + score > best[0]:
            best = (before + score, n - start, piece)
    return best or (states[n - 1][0] + vocabulary.unknown, 1, word[n - 1])


def segment(words: list[str], vocabulary: Vocabulary) -> Iterator[tuple[str, list[str]]]:
    """The pieces of every word, in sorted order: a depth-first walk through the words' trie."""
    states: list[State] = [(0.0, 0, "")]
    last = ""
    for word in sorted(set(words)):
        shared, top = 0, min(len(word), len(last))
        while shared < top and word[shared] == last[shared]:
            shared += 1
        del states[shared + 1 :]
        for n in range(shared + 1, len(word) + 1):
            states.append(next_state(states, word, n, vocabulary))
        parts, at = [], len(word)
        while at:
            parts.append(states[at][2])
            at -= states[at][1]
        yield word, parts[::-1]
        last = word


class Codec(dict):
    """Ids of marked words, as bytes, remembered by word (without its mark)."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.texts = [b""] * (max([*vocabulary.ids.values(), *vocabulary.byte_ids], default=0) + 1)
        for piece, i in vocabulary.ids.items():
            self.texts[i] = piece.replace(MARK, " ").encode()
        for b, i in enumerate(vocabulary.byte_ids):
            self.texts[i] = bytes([b])

    def learn(self, words: set[str]) -> None:
        for word, parts in segment([MARK + w for w in words if w not in self], self.vocabulary):
            self[word[1:]] = np.array([i for p in parts for i in self.vocabulary.id_list(p)], np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes of 32-bit numbers."""
        split = [units(t) for t in texts]
        if len(self) > CACHE:
            self.clear()
        self.learn({w for s in split for w in s})
        return [b"".join(map(self.__getitem__, s)) for s in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        text = b"".join(map(self.texts.__getitem__, np.frombuffer(ids, np.int32).tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def units(text: str) -> list[str]:
    """Marked words of a text without their first mark; further marks of a run stay with the word they lead."""
    if not text:
        return []
    parts = text.replace(MARK, " ").split(" ")
    if "" not in parts:
        return parts
    out, lead = [], ""
    for part in parts[:-1]:
        if part:
            out.append(lead + part)
            lead = ""
        else:
            lead += MARK
    return [*out, lead + parts[-1]]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(Vocabulary.load(path))
    return _codecs[path]


ROWS = 1500  # texts encoded together


def _mapped(df: DataFrame, column: str, name: str, kind: str, each: Callable[[list], pa.Array]) -> DataFrame:
    """``df`` with one more column made from ``column``, some rows at a time; a column that has the name already is replaced."""
    if name != column:
        df = df.drop(name)
    at, kept = df.columns.index(column), [i for i, c in enumerate(df.columns) if c != name]
    schema = StructType([df.schema.fields[i] for i in kept] + StructType.fromDDL(f"`{name}` {kind}").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), each(part.column(at))], names=schema.names)

    return df.mapInArrow(run, schema)


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and the ids of each text as an array of ints.  A null or empty text has no ids."""

    def each(column: pa.Array) -> pa.Array:
        found = codec(path).encode([t or "" for t in column.to_pylist()])
        sizes = np.array([len(x) // 4 for x in found], np.int32)
        return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(np.frombuffer(b"".join(found), np.int32)))

    return _mapped(docs, text, ids, "array<int>", each)


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and the text of each array of ids.  Null or empty ids give the empty text; null ids in them and ids outside the vocabulary are left out."""

    def each(column: pa.Array) -> pa.Array:
        known = codec(path)
        top = len(known.texts)
        return pa.array([known.decode(np.array([i for i in x or [] if i is not None and 0 <= i < top], np.int32).tobytes()) for x in column.to_pylist()], pa.string())

    return _mapped(encoded, ids, text, "string", each)


def encode_and_check(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its key, n_tokens, ids, and whether decoding the ids gives the text back.

    A null text is empty.  Rows that repeat a key, or have none, are encoded each; other columns are not read.  A literal U+2581 in a
    text is decoded as a space, as in the model's own decoder: such a row has round_trip false.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = known.encode(texts)
                sizes = np.array([len(x) // 4 for x in found], np.int64)
                ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), pa.array(np.frombuffer(b"".join(found), np.int32)))
                same = pa.array([known.decode(x) == t for x, t in zip(found, texts, strict=True)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes), ids, same], names=[key, "n_tokens", "ids", "round_trip"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids array<int>, round_trip boolean")
