from __future__ import annotations

import re

from helpers import ODD_TEXTS, by_id, docs, prose
from runway.llm import pii


def run(spark, texts, key="k"):
    rows = by_id(pii.replace(docs(spark, texts), key))
    return [rows[i]["text"] for i in range(len(texts))], [rows[i]["n_entities"] for i in range(len(texts))]


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def test_kinds_keep_their_format(spark):
    texts = ["write to und.34@mail7.example.com now", "IP 10.2.133.254, then", "call +1 (017) 555-7713 today",
             "card 4111 1111 1111 1111 end", "no 4111111111111112!!", 'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"!!',
             "TOKEN = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\"!!", "ssn 123-45-6789.", "iban DE89 3704 0044 0532 0130 00 ok",
             "Mr. James Smith met Frau Anna Müller", "Господин Иван Петров пришёл", "UND.34@MAIL7.EXAMPLE.COM"]
    out, n = run(spark, texts)
    assert all(a != b for a, b in zip(texts, out)) and n == [1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 1, 1]
    shape = lambda s: re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", s))
    for i in (0, 1, 2, 3, 4, 7, 8, 11):
        assert re.sub("a", "", shape(out[i])) == re.sub("a", "", shape(texts[i])) and len(out[i]) == len(texts[i])
    assert out[0].endswith(".com now") and out[0].startswith("write to ")
    assert all(0 <= int(o) <= 255 for o in re.search(r"[\d.]+\d", out[1]).group().split("."))
    assert out[2].startswith("call +1 (")
    assert luhn(re.sub(r"\D", "", out[3])) and re.search(r"\d", out[3]).group() == "4"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"!!', out[5]) and re.fullmatch(r'TOKEN = "[0-9A-F]{40}"!!', out[6])
    assert out[8].startswith("iban DE")
    male, surname, female = re.fullmatch(r"Mr\. (\w+) (\w+) met Frau (\w+) \w+", out[9]).groups()
    assert male.lower() in pii.GIVEN["male"] and female.lower() in pii.GIVEN["female"] and len(surname) == 5
    given, other = re.fullmatch(r"Господин (\w+) (\w+) пришёл", out[10]).groups()
    assert given.lower() in pii.GIVEN["male_cyrillic"] and re.fullmatch("[А-Яа-я]+", other)
    assert out[11] == out[0][len("write to "):-4].upper()  # one entity in two spellings


def test_coreference_and_key(spark):
    texts = ["a.1@x.org and A.1@X.ORG", "again a.1@x.org", "+1 (017) 555-7713", "+1-017-555-7713", "Dr. Smith", "Mary Smith"]
    out, _ = run(spark, texts)
    first = out[0].split(" and ")
    assert first[0].upper() == first[1] and out[1] == "again " + first[0]
    assert re.sub(r"\D", "", out[2]) == re.sub(r"\D", "", out[3])
    assert out[4].split()[-1] == out[5].split()[-1]
    assert run(spark, texts, "k")[0] == out and run(spark, texts, "other")[0] != out


def test_collisions_are_resolved(spark):
    # every two-figure combination of a small format: surrogates must stay distinct and new
    texts = [f"mail {c}{d}@m.xy" for c in "abcdefgh" for d in range(10)] * 2
    out, _ = run(spark, texts)
    mails = [t.split()[1] for t in out]
    assert len(set(mails)) == 80 and mails[:80] == mails[80:]
    assert not set(mails) & {t.split()[1] for t in texts}


def test_listed_names_keep_their_place(spark):
    # all listed names, and names from outside that sort before and after them
    outside = ["Aaron", "Adam", "Alan", "Anthony", "Zach"]
    texts = [f"Mr. {n.capitalize()} Smith" for n in pii.GIVEN["male"]] + [f"Mr. {n} Smith" for n in outside]
    out, _ = run(spark, texts)
    given = [t.split()[1].lower() for t in out]
    assert len(set(given)) == len(texts) and set(given[:16]) == set(pii.GIVEN["male"])
    assert all(a != b.split()[1].lower() for a, b in zip(given, texts))
    assert not set(given[16:]) & {n.lower() for n in outside}


def test_formats_with_too_few_values(spark):
    # more forms than surrogates of their format: each still gets one of its own
    names = [f"Mr {c}{v}" for c in "BCDFGHJKLMNPQRSTVWXZ" for v in "aeiou"] + [f"Mr {v}'" for v in "AEIOU"]
    ips = [f"v {n // 1000}.{n // 100 % 10}.{n // 10 % 10}.{n % 10}" for n in range(5000)]
    phones = [f"+1 {n // 100 % 10} {n % 100:02} 11" for n in range(300)]
    texts = names + ips + phones + ["password = '******'", "password = '********'"]
    out, n = run(spark, texts)
    assert set(n) == {1} and len(set(out)) == len(texts) and not set(out) & set(texts)
    assert all(re.fullmatch(r"Mr [A-Z][A-Za-z']+", t) for t in out[:len(names)])
    numbers = [t[2:].split(".") for t in out[len(names):len(names) + 5000]]
    assert all(len(x) == 4 and all(0 <= int(o) <= 255 for o in x) for x in numbers)


def test_bare_names_of_the_same_document(spark):
    texts = ["Mr. James Smith called. Smith left, James stayed; SMITH's car, Smithson, smith. Mr. Smith's hat",
             "Smith left, James stayed.", "Dr. Li The other. The end, Li.",
             "Frau Anna Smith-Jones. Smith-Jones saw Anna, a.b@x.org and Jones."]
    out, n = run(spark, texts)
    given, surname = re.match(r"Mr\. (\w+) (\w+) called", out[0]).groups()
    assert out[0] == (f"Mr. {given} {surname} called. {surname} left, {given} stayed; {surname.upper()}'s car, "
                      f"Smithson, smith. Mr. {surname}'s hat")
    assert given != "James" and surname != "Smith" and n == [5, 0, 2, 4] and out[1] == texts[1]
    li = re.match(r"Dr\. (\w+) ", out[2]).group(1)
    assert li != "Li" and out[2].endswith(f" other. The end, {li}.")
    anna, double = re.match(r"Frau (\w+) (\w+-\w+)\. ", out[3]).groups()
    assert f". {double} saw {anna}, " in out[3] and out[3].endswith(" and Jones.") and "Smith" not in out[3]


def test_clean_and_odd_texts_stay(spark):
    texts = [t for t in ODD_TEXTS] + ["Licensed under the Apache License, Version 2.0.", "MIT License 3.1 and CC BY-NC 4.0.",
                                      "on 2024-01-02 at 12:30, 1,000,000 times", "At At At Der Und The"]
    out, n = run(spark, texts)
    assert out == texts and set(n) == {0}
    long_text = prose(1, 20000) + " a.b@c.de " + prose(2, 20000)
    out, n = run(spark, [long_text])
    assert n == [1] and "a.b@c.de" not in out[0] and out[0].startswith(prose(1, 20000))


def test_repeats_extra_columns_and_empty_table(spark):
    df = docs(spark, [(None, "x a.b@c.de"), (1, "x a.b@c.de"), (1, "x a.b@c.de")]).selectExpr(
        "*", "7 AS kind", "8 AS form", "9 AS n_entities", "10 AS attempt", "11 AS _gaps", "12 AS _fix")
    rows = pii.replace(df).collect()
    assert len({r["text"] for r in rows}) == 1 and {r["n_entities"] for r in rows} == {1} and rows[0]["kind"] == 7
    assert pii.replace(docs(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = pii.replace(docs(spark, ["a.b@c.de"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
