from __future__ import annotations

import re

import numpy as np

from helpers import ODD_TEXTS, by_id, docs, prose
from runway.llm import cascade, langid, quality


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    often = {x for x in set(wins) if wins.count(x) > 1} if len(wins) < 3000 else set()
    covered = {p for i, x in enumerate(wins) if x in often for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_counts(spark):
    para = prose(1, 12)
    texts = ODD_TEXTS + [para + " " + para, "ha " * 40, "a\nb\na\n \n \n\na", "# x * y $ | <b>", para + "\n" + para + " tail " + para,
                         prose(2, 9) + " " + prose(2, 9)[:-3]]
    got = by_id(cascade.judge(docs(spark, texts)))
    for i, t in enumerate(texts):
        r, want = got[i], counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_verdicts_do_not_depend_on_the_order(spark):
    clean = prose(3, 60)
    texts = [clean, clean.upper(), clean + " ###" * 40, "\n".join(["- same line"] * 9 + [clean]), "1 2 3 4 " * 1 + " ".join(
        f"{i}-{i}" for i in range(60)), " ".join(f"{'x' * 30}{i}" for i in range(40))]
    want = [True, False, False, False, False, False]
    assert [by_id(cascade.judge(docs(spark, texts)))[i]["kept"] for i in range(6)] == want
    flipped = tuple(reversed(cascade.RULES))
    assert [by_id(cascade.judge(docs(spark, texts), flipped))[i]["kept"] for i in range(6)] == want
    ordered = cascade.order_rules(docs(spark, texts * 5))
    assert sorted(r.name for r in ordered) == sorted(r.name for r in cascade.RULES)
    assert by_id(cascade.judge(docs(spark, texts), ()))[1]["kept"]


def test_cascade_nulls_repeats_extra_columns_empty(spark):
    df = docs(spark, [(None, prose(1, 30)), (1, prose(1, 30)), (1, prose(1, 30))]).selectExpr("*", "1 AS words", "2 AS n_words")
    assert [r["kept"] for r in cascade.judge(df).collect()] == [True] * 3
    assert cascade.judge(docs(spark, [])).count() == 0


def vowels(seed, n, letters):
    """Words of a language: a hundred fixed ones over its letters."""
    own = np.random.default_rng(ord(letters[0]))
    known = ["".join(own.choice(list(letters), own.integers(4, 10))) for _ in range(100)]
    return " ".join(np.random.default_rng(seed).choice(known, n))


LANGS = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx"}


def lang_docs(spark, extra=()):
    rows = [(i, vowels(i, 12 + i % 40, LANGS[lang])) for i, lang in enumerate(list(LANGS) * 60)]
    df = spark.createDataFrame([(i, t, list(LANGS)[i % 3], "s", len(t)) for i, t in rows] + list(extra),
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df


def test_language_accuracy_on_held_out_rows(spark):
    df = lang_docs(spark)
    rows = langid.predict(df, langid.fit(df), keep=["lang"]).collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["lang_pred"] == r["kept_lang"] for r in held)
    assert all(0 <= r["score"] <= 1 and not r["rejected"] for r in rows)


def test_language_ignores_held_out_labels(spark):
    df = lang_docs(spark)
    wrong = df.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) AS lang", "source")
    assert "zz" not in langid.fit(wrong)


def test_language_is_learned_behind_a_common_opening(spark):
    # every text opens with the same licence, longer than what a text gives to the dictionary
    opening = "\n".join(f"Licence clause {i}: {prose(i, 8)}" for i in range(8)) + "\n"
    assert len(opening) > langid.DOC_CHARS
    rows = [(i, opening + vowels(i, 300, LANGS[lang]), lang) for i, lang in enumerate(list(LANGS) * 40)]
    df = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in rows], lang_docs(spark).schema)
    got = langid.predict(df, langid.fit(df), keep=["lang"]).where("held_out").collect()
    assert got and all(r["lang_pred"] == r["kept_lang"] and not r["rejected"] for r in got)


def test_language_margin_does_not_fall_with_length(spark):
    tools = langid.Compressors(langid.fit(lang_docs(spark)))
    long = vowels(5, 800_000, LANGS["bb"])
    assert len(long) > 5_000_000
    lang, score, rejected = tools.classify(long)
    assert lang == "bb" and not rejected
    assert score > 0.5 * tools.classify(long[:200_000])[1]  # their blocks differ in length


def test_language_unknown_nulls_repeats_empty(spark):
    df = lang_docs(spark, [(900, None, "aa", "s", 0), (901, "12 34 !", "aa", "s", 0), (902, "", None, None, None),
                           (None, "abc abd", "aa", "s", 7), (903, "abcde", "aa", "s", 5), (903, "abcde", "aa", "s", 5),
                           (904, vowels(5, 20000, LANGS["aa"]), None, "s", 1)])
    df = df.selectExpr("*", "1 AS score", "2 AS lang_pred", "3 AS kept_lang")
    model = langid.fit(df)
    rows = {}
    for r in langid.predict(df, model).collect():
        rows.setdefault(r["doc_id"], []).append(r)
    for i in (900, 901, 902):
        assert (rows[i][0]["lang_pred"], rows[i][0]["score"], rows[i][0]["rejected"]) == ("und", 0.0, True)
    assert rows[None][0]["lang_pred"] in LANGS and rows[None][0]["held_out"] is False
    assert len(rows[903]) == 2 and rows[903][0]["lang_pred"] == rows[903][1]["lang_pred"] and rows[904][0]["lang_pred"] == "aa"
    assert langid.fit(docs(spark, [])) == {} and langid.predict(docs(spark, []), {}).count() == 0
    assert by_id(langid.predict(docs(spark, ["text"]), {}))[0]["lang_pred"] == "und"


def quality_tables(spark):
    good = [prose(i, 40 + i) for i in range(90)]
    bad = [" ".join(w + "###" for w in prose(i, 40 + i).split()) if i % 2 else prose(i, 40).upper() + "!!!" for i in range(90)]
    df = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 90), 0) for i in range(180)] + [(None, 1, 0), (5, None, 0), (999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    return df, labels


def test_quality_accuracy_on_held_out_rows(spark):
    df, labels = quality_tables(spark)
    rows = quality.score(df, quality.fit(df, labels)).collect()
    held = [r for r in rows if r["held_out"]]
    assert held and all(r["predicted"] == (r["doc_id"] < 90) == (r["score"] >= 0.5) for r in held)


def test_quality_odd_texts_nulls_and_no_labels(spark):
    df, labels = quality_tables(spark)
    forest = quality.fit(df, labels)
    odd = docs(spark, ODD_TEXTS + [(None, "x"), (1, "y")]).selectExpr("*", "1 AS score", "2 AS x", "3 AS label")
    rows = quality.score(odd, forest).collect()
    assert len(rows) == len(ODD_TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    assert not [r["held_out"] for r in rows if r["doc_id"] is None][0]
    none = quality.fit(df, labels.where("false"))
    assert {r["score"] for r in quality.score(df, none).collect()} == {0.5}
    assert quality.score(docs(spark, []), none).count() == 0


def test_flattened_trees_match_the_growing_margin():
    r = np.random.default_rng(0)
    x = r.standard_normal((400, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    forest = quality.grow(x, y)
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.97

    def walk(t, row, k=0):
        child = forest.left[t, k]
        return forest.value[t, k] if child < 0 else walk(t, row, child + (row[forest.feature[t, k]] > forest.threshold[t, k]))

    plain = [forest.bias + sum(walk(t, row) for t in range(len(forest.left))) for row in x[:20]]
    assert np.allclose(forest.score(x[:20]), 1 / (1 + np.exp(-np.array(plain))))


def test_language_equals_a_plain_loop(spark):
    import zstandard

    df = lang_docs(spark, [(900, "Und " + vowels(3, 3000, "abcdef"), None, "s", 0), (901, "12 34", None, "s", 0), (902, None, None, "s", None)])
    model = langid.fit(df)
    assert len(model) == 3

    def sizes(raw, level):
        out = {}
        for lang, content in model.items():
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            tool = zstandard.ZstdCompressor(dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)
            blocks = -(-len(raw) // langid.BLOCK)
            step = -(-len(raw) // blocks)
            out[lang] = sum(len(tool.compress(raw[i:i + step])) for i in range(0, len(raw), step))
        return out

    for r in langid.predict(df, model, keep=["text"]).collect():
        text = r["kept_text"]
        if not text or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        raw = (" " + text.lower() + "\n").encode()
        for level in (langid.LEVEL, langid.FINE_LEVEL):
            s = sizes(raw, level)
            first, second = sorted(s.values())[:2]
            margin = (second - first) / second
            if margin >= langid.CLOSE:
                break
        assert s[r["lang_pred"]] == first and abs(r["score"] - margin) < 1e-12 and r["rejected"] == (margin < langid.MARGIN)


def plain_statistics(text):
    import math
    from collections import Counter

    if not text:
        return [0.0] * 21
    raw = list(text.encode())
    n, words, lines = len(raw), text.split(), text.split("\n")
    w = max(1, len(words))
    among = lambda s: sum(b in s.encode() for b in raw)
    upper = sum(65 <= b <= 90 for b in raw)
    letters = upper + sum(97 <= b <= 122 for b in raw) + sum(b >= 128 for b in raw)
    return [
        math.log(1 + n), math.log(1 + len(words)), (n - among(" \n")) / w, upper / max(1, letters), among("0123456789") / n, among(" ") / n,
        among("\n") / n, among(",.") / w, among("!?") / w, among("#*$%&|<>~^=+_@\\/{}[]") / n, among("\"'();:-`") / n,
        sum(b >= 128 for b in raw) / n, -sum(c / n * math.log2(c / n) for c in Counter(raw).values()), len(set(words)) / w,
        len(set(lines)) / len(lines), len(words) / len(lines), max(Counter(words).values(), default=0) / w, sum(x.isupper() for x in words) / w,
        sum(len(x) <= 2 for x in words) / w, sum(len(x) >= 12 for x in words) / w, sum(not x[-1].isalnum() for x in words) / w]


def test_quality_statistics_and_scores_equal_plain_ones(spark):
    texts = [*ODD_TEXTS[:-1], prose(5, 300), "A b, C! <x> 12\nA b, C! <x> 12\n\nUPPER lower \"quoted\" (so) #tag", "ß–… ÄÖ 123"]
    for t in texts:
        assert np.allclose(quality.statistics(t), plain_statistics(t), rtol=1e-12, atol=1e-12), t
    rows = [(i, prose(i, 40) if i % 2 else "## " * (20 + i)) for i in range(120)] + [(200 + i, t) for i, t in enumerate(texts)]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    forest = quality.fit(df, labels)
    for r in quality.score(df, forest).collect():
        x, total = plain_statistics(dict(rows)[r["doc_id"]]), forest.bias
        for f, t, left, v in zip(forest.feature, forest.threshold, forest.left, forest.value):
            at = 0
            while left[at] >= 0 and (nxt := left[at] + (x[f[at]] > t[at])) != at:
                at = nxt
            total += v[at]
        assert abs(r["score"] - 1 / (1 + np.exp(-total))) < 1e-9 and r["predicted"] == int(r["score"] >= 0.5)
