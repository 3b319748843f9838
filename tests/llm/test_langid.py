from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import langid

SYLLABLES = {
    "en": "the ing tion wh ou ed sh and ly er", "de": "sch ung ein lich keit ver ü pf und tz", "nl": "ij oe heid ver een aan sch ui het de",
    "fr": "eau ç que les aux ment é oi tre le", "es": "ción ñ los ado mente que ar ó el ía", "xx": "qa zu kwo mbe nga yi tlo xhu wa pe",
}


def text(lang, draw, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 3))) for _ in range(n))


def corpus(seed=5, n=60):
    draw = random.Random(seed)
    return [(i, text(lang, draw, draw.randint(8, 80)), lang) for i, lang in enumerate(lang for _ in range(n) for lang in SYLLABLES)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "h", 2, "v") for r in rows], "doc_id long, text string, lang string, h string, n_words int, vector string").repartition(3)


@pytest.fixture(scope="module")
def found(spark, docs):
    rows = corpus()
    return {r.doc_id: r for r in langid.languages(frame(spark, rows)).collect()}, rows


def test_held_out_languages_are_told_apart(found):
    by_id, rows = found
    held = [(by_id[i].lang_pred, lang) for i, _, lang in rows if by_id[i].held_out]
    assert {i for i, r in by_id.items() if r.held_out} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in by_id.values())


def test_predictions_do_not_look_at_languages_or_ids(spark, found):
    by_id, rows = found
    model_rows = [(i, t, lang if zlib.crc32(str(i).encode()) % 4 != 2 else "en") for i, t, lang in rows]
    again = {r.doc_id: r.lang_pred for r in langid.languages(frame(spark, model_rows)).collect()}
    assert again == {i: r.lang_pred for i, r in by_id.items()}


def test_family_comes_first_and_pairs_stay_inside(spark, docs):
    learned = langid.training_rows(frame(spark, corpus()), "doc_id", "text", "lang", 1000)
    model = langid.fit(learned)
    assert model.langs == ["de", "en", "es", "fr", "nl", "xx"]
    names = [{model.langs[a], model.langs[b]} for a, b in model.pairs]
    assert names == [{"de", "en"}, {"de", "nl"}, {"en", "nl"}, {"es", "fr"}] or sorted(map(sorted, names)) == [["de", "en"], ["de", "nl"], ["en", "nl"], ["es", "fr"]]
    x = np.vstack(list(langid.gram_features(pa.array(["schungein ver", "", "qazu mbe"]))))
    lang, score = model.predict(x)
    assert model.langs[lang[2]] == "xx" and ((score >= 0) & (score <= 1 + 1e-9)).all()


def test_language_without_letters_nulls_and_copies(spark, docs):
    rows = [*corpus(n=20), (900, None, "en"), (901, "", "en"), (902, " 12 !?\n", "fr"), (903, "the", None), (None, "the and thing", "en"), (904, text("de", random.Random(1), 40_000), "de")]
    rows += [(905, "the shing and", "en")] * 50
    out = langid.languages(frame(spark, rows)).collect()
    by_id = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[903].lang_pred == "en" and by_id[904].lang_pred == "de" and by_id[None].lang_pred == "en"
    assert all(r.lang_pred == "en" for r in out if r.doc_id == 905)


def test_nothing_and_nothing_to_learn_from(spark, nothing):
    assert langid.languages(nothing).count() == 0
    unknown = frame(spark, [(1, "the and", None), (2, None, "en")])
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.languages(unknown).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}
    one = frame(spark, [(i, "the and shing", "en") for i in range(8)])
    assert {r.lang_pred for r in langid.languages(one).collect()} == {"en"}


def test_training_rows_are_bounded_distinct_and_independent_of_layout(spark, docs):
    rows = corpus(n=80)
    df = frame(spark, rows + [(r[0] + 4000, *r[1:]) for r in rows])

    def chosen(df):
        return {(r.lang, r.h) for r in langid.training_rows(df, "doc_id", "text", "lang", 12).select("lang", "h").collect()}

    first = chosen(df)
    assert {lang: sum(x == lang for x, _ in first) for lang in SYLLABLES} == dict.fromkeys(SYLLABLES, 12)
    assert chosen(df.repartition(7)) == first


def plain_features(text, places):
    data = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in text.encode().lower())
    value = [b + 1 for b in data]
    out = np.zeros(places)
    for size in langid.GRAMS:
        for i in range(len(value) - size + 1):
            total = sum(value[i + j] * pow(langid._BASE, j, 1 << 64) for j in range(size)) % (1 << 64)
            out[int(langid.mix(np.array([total], np.uint64))[0]) % places] += 1
    root = np.sqrt(out)
    return root / max(np.linalg.norm(root), 1e-12)


@pytest.mark.parametrize("size, rows", [(16, 2), (7, 100), (1 << 19, 3)])
def test_features_do_not_depend_on_slices(monkeypatch, size, rows):
    monkeypatch.setattr(langid, "SLICE", size)
    monkeypatch.setattr(langid, "ROWS", rows)
    texts = ["Hello, world", None, "", "ab", "a", "The quick brown FOX jumps 123 over it", "x" * 40, "naive cafe"]
    got = np.vstack(list(langid.gram_features(pa.array(texts), 64)))
    assert got == pytest.approx(np.array([plain_features(t or "", 64) for t in texts]), abs=1e-12)


def test_families_are_a_plain_table():
    assert langid.family_of("de") == langid.family_of("en") == "germanic" and langid.family_of("xx") == "xx"
    codes = [c for names in langid.FAMILIES.values() for c in names.split()]
    assert len(codes) == len(set(codes)) < 200


def test_names_of_the_output(found):
    by_id, _ = found
    assert all(list(r.asDict()) == ["doc_id", "held_out", "lang_pred", "score"] and None not in r.asDict().values() for r in by_id.values())
