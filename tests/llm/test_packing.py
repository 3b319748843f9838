from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as tokenizers_of
import pytest

from opinara.llm import packing, pieces

JSON, RANKS, MODEL = (tokenizers_of.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
ODD = ["", " ", "  ", "a  b", "a \n b", "a\n \nb", "x   ", " \n ", "it 's", "<|endoftext|> a", "\t\x00\x1c a  b  c", "日本語 😀 é" * 20, "a" * 3000, " " * 300 + "b", " lead", "tab\t end \t"]


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    own, other = packing.Encoder(JSON, RANKS), Tokenizer.from_file(JSON)
    for text in [*ODD, *ODD]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("length, expected", [(1, [(0, 1)]), (2048, [(0, 2048)]), (2049, [(0, 1), (1, 2048)]), (4100, [(0, 4), (4, 2048), (2052, 2048)])])
def test_cuts(length, expected):
    assert packing.cuts(length, 2048) == expected


@pytest.mark.parametrize("seed", range(20))
def test_fullest_is_the_best_subset(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(4)}
    room = rng.randint(1, 60)
    reach = {0}
    for n, c in counts.items():
        reach = {r + n * k for r in reach for k in range(c + 1)}
    used = packing.fullest(room, counts, sorted(counts, reverse=True))
    assert sum(n * k for n, k in used) == max(r for r in reach if r <= room)
    assert all(k <= counts[n] for n, k in used)


def test_plan_uses_every_length_and_few_bins():
    rng = np.random.default_rng(1)
    counts = dict(Counter(rng.integers(1, 101, 5000).tolist()))
    made = packing.plan(counts, 100)
    total = sum(n * c for n, c in counts.items())
    assert made.sequences <= -(-total // 100) * 1.02 + 1
    used = Counter()
    for combination, times in packing.bins(counts, 100):
        assert sum(n * k for n, k in combination) <= 100
        for n, k in combination:
            used[n] += k * times
    assert used == counts


def test_documents_are_packed_whole(docs):
    rows = packing.pack_documents(docs, JSON, RANKS, capacity=512).collect()
    expected = Counter()
    encode = packing.Encoder(JSON, RANKS).encode
    for r in docs.collect():
        ids = encode(r.text or "") + packing.END
        for piece, (start, n) in enumerate(packing.cuts(len(ids) // 4, 512)):
            expected[r.doc_id, piece, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))
        assert sum(own[-1]) <= 512


def test_nothing_to_pack(nothing):
    assert packing.pack_documents(nothing, JSON, RANKS).count() == 0


def test_pieces_are_those_of_the_model():
    from sentencepiece import SentencePieceProcessor

    model, own = SentencePieceProcessor(model_file=MODEL), pieces.Codec(pieces.Vocabulary.load(MODEL))
    texts = [*ODD, "<s> ok", "▁ ▁▁a", "ａ ﬁ", "Überraschung naïve 12345 $$$"]
    for ids, text in zip(own.encode(texts), texts, strict=True):
        found = np.frombuffer(ids, np.int32).tolist()
        assert found == model.encode(text), text
        assert own.decode(ids) == model.decode(found)


@pytest.mark.parametrize("seed", range(30))
def test_unigram_segmentation_is_the_best(seed):
    rng = random.Random(seed)
    scores = {c: -rng.random() * 9 for c in "abc"} | {"".join(rng.choice("abc") for _ in range(rng.randint(2, 4))): -rng.random() * 9 for _ in range(12)}
    vocabulary = pieces.Vocabulary(scores, {p: i for i, p in enumerate(scores)}, [], merges=False)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(20)]

    def best(word):
        return 0.0 if not word else max(scores[word[:n]] + best(word[n:]) for n in range(1, len(word) + 1) if word[:n] in scores)

    found = dict(pieces.segment(words, vocabulary))
    assert set(found) == set(words)
    for word, parts in found.items():
        assert "".join(parts) == word and abs(sum(scores[p] for p in parts) - best(word)) < 1e-9


def test_round_trip(docs, nothing):
    rows = pieces.encode_and_check(docs, MODEL).collect()
    assert len(rows) == docs.count() and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    both = pieces.decode_ids(pieces.encode_texts(docs, MODEL), MODEL).collect()
    assert all(r.decoded == (r.text or "") for r in both)
    assert pieces.encode_and_check(nothing, MODEL).count() == 0


def test_a_unigram_model_is_read_as_one(tmp_path):
    """A model file written by hand, whose best paths are not what merging would give."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    model = proto.ModelProto()
    model.trainer_spec.model_type = 1  # unigram
    model.normalizer_spec.name = "identity"
    model.pieces.add(piece="<unk>", score=0.0, type=2)
    plain = {"▁": -3.25, "a": -2.5, "b": -2.75, "c": -4.125, "ab": -4.5, "bc": -3.125, "▁a": -3.75, "abc": -8.5, "cab": -5.25, "▁ab": -5.75}
    for piece, score in plain.items():
        model.pieces.add(piece=piece, score=score, type=1)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    vocabulary = pieces.Vocabulary.load(str(path))
    assert not vocabulary.merges and pieces.Vocabulary.load(MODEL).merges
    theirs, draw = SentencePieceProcessor(model_file=str(path)), random.Random(3)
    words = ["".join(draw.choices("abc", k=draw.randint(1, 9))) for _ in range(200)]
    own = dict(pieces.segment(sorted({"▁" + w for w in words}), vocabulary))
    for w in words:
        score = sum(plain[p] for p in own["▁" + w])
        assert score == pytest.approx(sum(plain[p] for p in theirs.encode(w, out_type=str)))
