from pyspark.sql import functions as F

from barfold.llm import language


def learned(spark, texts):
    rows = [(n, texts(lang, n), lang) for n in range(40) for lang in ("en", "de")]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))


def test_languages_of_unseen_texts(spark, texts):
    model = learned(spark, texts)
    rows = [(n, texts(lang, 1000 + n), lang) for n in range(30) for lang in ("en", "de")]
    found = language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model)
    assert all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in found.collect())


def test_language_of_mostly_copies_is_learned(spark, texts):
    page = [(n, texts("de", "page"), "de") for n in range(6000)]
    rows = [(n, texts(lang, n), lang) for n in range(60) for lang in ("en", "de")]
    frame = spark.createDataFrame(page + rows, "doc_id long, text string, lang string")
    model = language.fit(frame, F.lit(True), docs_per_lang=50, min_share=0.1)
    unseen = [(n, texts("de", 1000 + n), "de") for n in range(30)] + page[:1]
    found = language.predict(spark.createDataFrame(unseen, frame.schema), model).collect()
    assert all(r["lang_pred"] == "de" and r["score"] > 0.5 for r in found)


def test_language_of_one_text_is_learned(spark, texts):
    rows = [(n, texts("de", "page"), "de") for n in range(20)] + [(n, texts("en", n), "en") for n in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict(frame, language.fit(frame, F.lit(True))).collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.5 for r in found)


def test_odd_rows(spark, texts, odd_rows):
    found = language.predict(odd_rows, learned(spark, texts)).collect()
    assert len(found) == odd_rows.count()
    by_id = {r["doc_id"]: r for r in found}
    for number in (2, 3, 4):
        assert (by_id[number]["lang_pred"], by_id[number]["score"]) == ("und", 0.0)
    assert by_id[1]["lang_pred"] == by_id[6]["lang_pred"] == "en"
    assert by_id[None]["lang_pred"] == "de"
    assert by_id[7]["lang_pred"] in ("en", "de")
    assert by_id[1]["ids"] == "x"


def test_letters_beyond_ascii_are_letters(spark, texts):
    rows = spark.createDataFrame([(1, "日本"), (2, "— … 123")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(rows, learned(spark, texts)).collect()}
    assert found == {1: "de", 2: "und"}  # equally frequent, so the first


def test_nothing_learned(spark, odd_rows, no_rows):
    model = language.fit(no_rows, F.lit(True))
    assert {r["lang_pred"] for r in language.predict(odd_rows, model).collect()} == {"und"}
    assert language.predict(no_rows, model).count() == 0


def test_more_languages_than_a_word_has_bits(spark):
    langs = [f"l{n:02d}" for n in range(70)]
    rows = [(n, " ".join(f"{lang[1:].translate(str.maketrans('0123456789', 'abcdefghij'))}{c}xyz" for c in "qrstuv"), lang)
            for n in range(3) for lang in langs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict(frame, language.fit(frame, F.lit(True), slots=1 << 14)).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def grams_of(text):
    """n-grams by plain Python: runs of 3 and 5 bytes, letters inside, a letter or an edge at both ends."""
    data = b" " + (text or "").lower().encode() + b"\n"
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 0 for b in data)
    return [data[i : i + n] for n in language.SIZES for i in range(len(data) - n + 1) if 0 not in data[i + 1 : i + n - 1]]


def test_filters_against_exact_sets(spark, texts):
    rows = [(n, texts(lang, n), lang) for n in range(40) for lang in ("en", "de")]
    model = learned(spark, texts)
    exact = {}
    for lang in ("de", "en"):
        held = [set(grams_of(t)) for _, t, of in rows if of == lang]
        least = max(1.0, 0.01 * len(held))
        exact[lang] = {g for g in set().union(*held) if sum(g in h for h in held) >= least}
    unseen = [(n, texts(lang, 1000 + n), None) for n in range(20) for lang in ("en", "de")]
    found = language.predict(spark.createDataFrame(unseen, "doc_id long, text string, lang string"), model).collect()
    for row in found:
        mine = grams_of(row["text"])
        shares = {lang: sum(g in known for g in mine) / len(mine) for lang, known in exact.items()}
        assert row["lang_pred"] == max(shares, key=shares.get)
        assert abs(row["score"] - max(shares.values())) < 0.03
