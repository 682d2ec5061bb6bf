"""Personal data: surrogate generation with DataFrame expressions only.

Mentions are found by one pattern; names are found behind a title or as a listed
given name with a surname. The tokens of a document's names are then looked for
on their own in the rest of that document (as written, or in capitals). Each is read as a kind and a canonical form
(case, spacing and separators taken off), so all mentions of one entity share
a form. Its surrogate is drawn from a keyed digest of kind, form and attempt:
digits become digits, vowels vowels, consonants consonants of the same script;
given names come from a list of the same gender and script; addresses keep
their octet lengths, cards their scheme digit and check digit, phones their
country code, mail addresses their top-level domain. It is written in the
mention's own format: case, spacing, separators and prefixes stay.

Collision check: over the distinct entities of the whole input, a surrogate
must be unique in its kind and equal no form that occurs (listed given names
only have to be unique). A listed name keeps its place in the rotation; any
other entity that loses moves on to its next attempt until none collides. A
format may hold fewer values than entities, so from attempt FREE_FORM on the
surrogate leaves it: it grows by keyed characters, more with each attempt (an
IP address first takes octets of any length), until all are distinct. Only documents with
such an entity read the changed attempts; all others are rewritten in the scan.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.llm.common import stage

KEY = "runway-surrogates"  # default; pass a secret one in production
FREE_FORM = 8  # from this attempt on a surrogate gives up its format, which may hold too few values
BROADCAST_ROWS = 10_000  # documents with changed attempts that may be broadcast, by count

# Given names by gender and script; a name maps to another of its list.
GIVEN = {
    "male": ["james", "john", "robert", "michael", "david", "william", "thomas", "peter", "pierre", "louis", "hans",
             "karl", "carlos", "miguel", "pablo", "diego"],
    "female": ["mary", "anna", "linda", "susan", "sarah", "karen", "laura", "emma", "marie", "claire", "heidi", "greta",
               "carmen", "lucia", "elena", "sofia"],
    "male_cyrillic": ["иван", "пётр", "сергей", "алексей", "дмитрий", "николай", "андрей", "михаил"],
    "female_cyrillic": ["анна", "мария", "елена", "ольга", "наталья", "ирина", "татьяна", "светлана"],
}
MALE_TITLES = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин"]
FEMALE_TITLES = ["Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"]
TITLES = [*MALE_TITLES, *FEMALE_TITLES, "Dr", "Prof"]
# title-case words that the pattern may take into a name, but that are no name on their own
NOT_NAMES = ("a an and are as at but by for from he her his how i if in is it its my no not of on or our she so that the "
             "their then there these they this those to was we were what when where who why with yes you your "
             "der die das den dem und ein eine er sie es ist im am zu mit von le la les un une et il elle du des de est "
             "el los las un una y en es con del al и в на он она они это не по с к за от").split()

_BEFORE, _AFTER = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_SECRET = r"(?i:token|secret|api[_-]?key|password|passwd)[\"']?\s{0,4}[:=]\s{0,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# the lower-case rest of a name's token, without a possessive ending if something is left then
_REST = r"(?:(?:(?!'s(?!\p{L}))[\p{Ll}'-])+|[\p{Ll}'-]+)\p{L}*"
_GIVEN_ALL = "|".join(n.capitalize() for names in GIVEN.values() for n in names)
PATTERN = "|".join([
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    _SECRET + r"(?:[\"'][^\s\"']{6,200}|(?=[^\s\"']{0,200}\d)[^\s\"']{8,200})",
    _BEFORE + r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36})" + _AFTER,
    r"(?<![\p{L}\p{N}.])" + _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.?\p{N})",
    r"(?<!\p{N})\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\p{N})",
    r"(?<!\p{N})\(\d{3}\) ?\d{3}-\d{4}(?!\p{N})|" + _BEFORE + r"\d{3}[.-]\d{3}[.-]\d{4}" + _AFTER,
    _BEFORE + r"\d{3}-\d{2}-\d{4}" + _AFTER,
    _BEFORE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _AFTER,
    _BEFORE + r"\d(?:[ -]?\d){12,18}" + _AFTER,
    r"(?<!\p{L})(?:" + "|".join(TITLES) + r")\.? \p{Lu}" + _REST + r"(?: \p{Lu}" + _REST + "){0,2}",
    r"(?<!\p{L})(?:" + _GIVEN_ALL + r") \p{Lu}\p{Ll}(?:(?:(?!'s(?!\p{L}))[\p{L}'-])+|[\p{L}'-]+)",
])
# what a text must hold for the pattern to be worth trying
HINT = r"[@\d]|(?i:token|secret|api[_-]?key|password|passwd)|" + r"(?<!\p{L})(?:" + "|".join(TITLES) + "|" + _GIVEN_ALL + r")\.? \p{Lu}"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parse(m: Column) -> Column:
    """A mention as prefix (stays as it is), tokens, and their units (kind, form)."""
    assigned = F.regexp_extract(m, r"^(" + _SECRET + r"[\"']?)", 1)
    title = F.regexp_extract(m, r"^((?:" + "|".join(TITLES) + r")\.? )", 1)
    kind = (F.when(m.rlike("^" + _SECRET), "secret")
            .when(m.contains("@"), "email")
            .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
            .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
            .when(m.rlike(r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$"), "phone")
            .when(m.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA.*|gh[pousr]_.*)$"), "secret")
            .when(m.rlike(r"^[A-Z]{2}\d{2}"), "iban")
            .when(m.rlike(r"^\d"), "card").otherwise("name"))

    def units(p: Column) -> Column:
        rest = F.substring(m, F.length(p["prefix"]) + 1, F.length(m))
        tokens = F.when(p["kind"] == "name", F.split(rest, " ")).otherwise(F.array(rest))
        return _let(tokens, lambda t: F.struct(p["prefix"].alias("prefix"), t.alias("tokens"), F.transform(
            t, lambda x, i: _let(
                F.when(p["kind"] == "name", _name_kind(p["prefix"], x, i, t)).otherwise(p["kind"]),
                lambda k: F.struct(k.alias("kind"), _form(k, x).alias("form")))).alias("units")))

    return _let(kind, lambda k: _let(F.struct(k.alias("kind"), F.when(k == "secret", assigned).when(
        k == "name", title).otherwise("").alias("prefix")), units))


def _form(kind: Column, body: Column) -> Column:
    """Canonical form of a body that is no name."""
    digits = F.regexp_replace(body, r"\D", "")
    return (F.when(kind.isin("card", "ssn"), digits)
            .when((kind == "phone") & body.startswith("+"), F.concat(F.lit("+"), digits))
            .when(kind == "phone", digits)
            .when(kind == "iban", F.upper(F.replace(body, F.lit(" "), F.lit(""))))
            .otherwise(F.lower(body)))


def _name_kind(prefix: Column, token: Column, at: Column, tokens: Column) -> Column:
    """given_<list> or surname for one token of a name."""
    low, out = F.lower(token), F
    for group, names in GIVEN.items():
        out = out.when(low.isin(names), "given_" + group)
    first = (at == 0) & (F.size(tokens) > 1)
    male, female = (prefix.rlike(r"^(?:" + "|".join(t) + r")\.? $") for t in (MALE_TITLES, FEMALE_TITLES))
    script = F.when(token.rlike(r"\p{IsCyrillic}"), "_cyrillic").otherwise("")
    return (out.when(first & male, F.concat(F.lit("given_male"), script))
            .when(first & female, F.concat(F.lit("given_female"), script)).otherwise("surname"))


def _listed(kind: Column, form: Column) -> Column:
    """Whether a form is in the list of its kind."""
    out = F.lit(False)
    for group, names in GIVEN.items():
        out = out | ((kind == "given_" + group) & form.isin(names))
    return out


def _surrogate(key: str, kind: Column, form: Column, attempt: Column) -> Column:
    """Replacement of a canonical form."""
    seed = F.concat_ws("|", F.lit(key), kind, form, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("|2")), 256))
    return _let(stream, lambda x: _let(F.struct(*[
        F.translate(x, "0123456789abcdef", v).alias(k) for k, v in _ALPHABETS.items()]),
        lambda drawn: _draw(key, kind, form, attempt, x, drawn)))


# what the sixteen digits of a digest stand for, by class of character
_ALPHABETS = {
    "digit": "0123456789204681", "hex": "abcdefabcdabcdef",
    "vowel": "aeiouaeiouaeioua", "other": "bcdfghklmnprstvz",
    "cyr_vowel": "аеиоуаеиоуаеиоуа", "cyr_other": "бвгджзклмнпрстфх",
    "gr_vowel": "αεηιοαεηιοαεηιοα", "gr_other": "βγδζθκλμνξπρστφχ",
    "han": "王李张刘陈杨黄赵周吴徐孙马朱胡郭"}


def _draw(key: str, kind: Column, form: Column, attempt: Column, stream: Column, drawn: Column) -> Column:
    n = F.length(form)
    lead = (F.when((kind == "phone") & form.rlike(r"^\+[17]"), 2).when((kind == "phone") & form.startswith("+"), 3)
            .when(kind == "card", 1).when(kind == "iban", 2).otherwise(0))
    tail = F.when(kind == "email", F.length(F.regexp_extract(form, r"(\.[^.@]+)$", 1))).otherwise(0)
    is_hex = (kind == "secret") & form.rlike("^[0-9a-f]+$")

    def swap(c: Column, i: Column) -> Column:
        at = i % 128 + 1
        take = lambda name: F.substring(drawn[name], at, F.lit(1))
        low = F.lower(c)
        new = (F.when(c.rlike("[0-9]"), take("digit")).when(is_hex, take("hex"))
               .when(low.rlike("[aeiouyà-æè-ïò-öù-ýœ]"), take("vowel")).when(low.rlike(r"\p{IsLatin}"), take("other"))
               .when(low.rlike("[аеёиоуыэюя]"), take("cyr_vowel")).when(low.rlike(r"\p{IsCyrillic}"), take("cyr_other"))
               .when(low.rlike("[αεηιουωάέήίόύώ]"), take("gr_vowel")).when(low.rlike(r"\p{IsGreek}"), take("gr_other"))
               .when(c.rlike(r"\p{L}"), take("han")).otherwise(c))
        new = F.when(kind == "iban", F.upper(new)).otherwise(new)
        return F.when((i < lead) | (i >= n - tail), c).otherwise(new)

    def more() -> Column:
        """What a surrogate grows by, in characters of its own sort."""
        letters = F.when(kind.isin("phone", "card", "ssn", "iban"), drawn["digit"]).when(is_hex, stream)
        for script, name in (("Cyrillic", "cyr_other"), ("Greek", "gr_other"), ("Han", "han")):
            letters = letters.when(form.rlike(r"\p{Is" + script + "}"), drawn[name])
        return F.substring(letters.otherwise(drawn["other"]), F.lit(65), grown)

    grown = F.least(4 * (attempt - FREE_FORM + 1), F.lit(64))
    free_form = attempt >= FREE_FORM

    def finish(plain: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(
            F.substring(plain, F.lit(1), F.length(plain) - 1), d.cast("string")))
        checked = F.get(F.filter(tries, lambda x: F.call_function("luhn_check", x)), F.lit(0))
        octets = F.array_join(F.transform(F.split(form, r"\."), lambda o, i: (
            F.when(F.length(o) == 1, F.substring(drawn["digit"], 3 * i + 1, F.lit(1)))
            .when(F.length(o) == 2, F.concat(F.translate(F.substring(drawn["digit"], 3 * i + 1, F.lit(1)), "0", "5"),
                                             F.substring(drawn["digit"], 3 * i + 2, F.lit(1))))
            .otherwise(F.concat(F.lit("1"), F.substring(drawn["digit"], 3 * i + 2, F.lit(2)))))), ".")
        # four octets of any length; much later attempts take more of them
        last = F.least(F.greatest(attempt - FREE_FORM - 4, F.lit(3)), F.lit(63))
        any_octets = F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: F.conv(
            F.substring(stream, 2 * i + 1, F.lit(2)), 16, 10)), ".")
        free = F.concat(F.lit("u"), F.substring(stream, F.lit(1), 8 + grown), F.regexp_extract(plain, "(@.*)$", 1))
        out = (F.when((kind == "ip") & free_form, any_octets).when(kind == "ip", octets)
               .when((kind == "card") & F.call_function("luhn_check", form), checked)
               .when((kind == "email") & free_form, free))
        for group, names in GIVEN.items():
            # a keyed rotation of the list is one to one; a name from outside the list gets a keyed place in it
            listed = F.array(*map(F.lit, names))
            shift = F.pmod(F.xxhash64(F.lit(key), F.lit(group)), F.lit(len(names) - 1)) + 1
            outside = F.pmod(F.xxhash64(F.lit(key), form, attempt), F.lit(len(names)))
            inside = form.isin(names)
            at = F.when(inside, (F.array_position(listed, form) - 1 + shift) % len(names)).otherwise(outside)
            # a list can run out of names: later attempts write new ones
            out = out.when((kind == "given_" + group) & (inside | (attempt < 4)), F.get(listed, at.cast("int")))
        return out.otherwise(plain)

    plain = F.array_join(F.transform(F.split(form, ""), swap), "")
    return _let(F.when(free_form & (kind != "email"), F.concat(plain, more())).otherwise(plain), finish)


def _write(body: Column, new: Column, attempt: Column) -> Column:
    """``new`` in the format of ``body``: letters and digits in its places and case.
    One that has left the format is written as it is, but for the case."""
    return _let(F.regexp_replace(new, r"[^\p{L}\p{N}]", ""), lambda letters: _place(body, new, letters, attempt))


def _place(body: Column, new: Column, letters: Column, attempt: Column) -> Column:
    same = (attempt < FREE_FORM) & (F.length(letters) == F.length(F.regexp_replace(body, r"[^\p{L}\p{N}]", "")))
    filled = F.aggregate(
        F.split(body, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(c.rlike(r"[\p{L}\p{N}]"), F.struct(
            F.concat(acc["out"], F.when(c != F.lower(c), F.upper(F.substring(letters, acc["at"], F.lit(1)))).otherwise(
                F.substring(letters, acc["at"], F.lit(1)))).alias("out"), (acc["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: acc["out"])
    other = F.when((body == F.upper(body)) & (F.length(body) > 1), F.upper(new)).when(
        F.substring(body, 1, 1) != F.lower(F.substring(body, 1, 1)), F.initcap(new)).otherwise(new)
    return F.when(same, filled).otherwise(other)


def _found(docs: DataFrame) -> DataFrame:
    """Adds _gaps (text between mentions, as pieces and the bare names between
    them), _parsed and _names (a map of the document's name tokens); null where there is
    no mention."""
    hinted = F.when(F.col("text").rlike(HINT), F.expr(f"regexp_extract_all(text, r'{_sql(PATTERN)}', 0)"))
    df = docs.withColumn("_mentions", hinted)
    has = F.size("_mentions") > 0
    df = (df.withColumn("_between", F.when(has, F.split("text", PATTERN, -1)))
          .withColumn("_parsed", F.when(has, F.transform("_mentions", _parse))).drop("_mentions"))
    # a token as written or in capitals, its kind and form; of a spelling's several the first counts
    tokens = F.flatten(F.transform("_parsed", _name_tokens))
    df = df.withColumn("_spelt", F.array_sort(F.flatten(F.transform(tokens, lambda x, i: F.transform(
        F.array(x["token"], F.upper(x["token"])),
        lambda t: F.struct(t.alias("token"), i.alias("at"), x["kind"].alias("kind"), x["form"].alias("form")))))))
    df = df.withColumn("_spelt", F.filter("_spelt", lambda x, i: (i == 0) | (
        F.get(F.col("_spelt"), i - 1)["token"] != x["token"])))
    df = df.withColumn("_names", F.map_from_arrays(F.transform("_spelt", lambda x: x["token"]), "_spelt"))
    df = df.withColumn("_bare", F.when(F.size("_spelt") > 0, _bare_pattern(F.col("_spelt")))).drop("_spelt")

    def pieces(gap: Column) -> Column:
        bare = F.col("_bare")
        return F.struct(
            F.when(bare.isNull(), F.array(gap)).otherwise(F.split(gap, bare, -1)).alias("pieces"),
            F.when(bare.isNull(), F.array().cast("array<string>")).otherwise(
                F.regexp_extract_all(gap, bare, F.lit(0))).alias("words"))

    return df.withColumn("_gaps", F.transform("_between", pieces)).drop("_between", "_bare")


def _name_tokens(p: Column) -> Column:
    """token, kind, form of a mention's tokens that are names on their own."""
    tokens = F.transform(p["tokens"], lambda t, i: F.struct(
        t.alias("token"), F.get(p["units"], i)["kind"].alias("kind"), F.get(p["units"], i)["form"].alias("form")))
    return F.filter(tokens, lambda x: ((x["kind"] == "surname") | x["kind"].startswith("given_"))
                    & ~x["form"].isin(NOT_NAMES))


def _bare_pattern(names: Column) -> Column:
    """A pattern of a document's name tokens (letters, apostrophes, hyphens), longest first."""
    spelt = F.array_sort(F.transform(names, lambda x: x["token"]), lambda a, b: F.length(b) - F.length(a))
    return F.concat(F.lit(_BEFORE + r"(?=\p{Lu})(?:"), F.array_join(spelt, "|"), F.lit(")" + _AFTER))


def _sql(pattern: str) -> str:
    return pattern.replace("'", r"\x27")


def _entity_key(kind: Column, form: Column) -> Column:
    return F.concat_ws(":", kind, form)


def changed_attempts(found: DataFrame, key: str) -> DataFrame:
    """kind, form, attempt of the entities that do not get their first surrogate."""
    entities = found.where("_parsed IS NOT NULL").select(F.explode(F.flatten("_parsed.units")).alias("u")).select(
        "u.kind", "u.form").distinct()
    entities = stage(entities, "entities")
    forms = entities.select("kind", F.col("form").alias("new"), F.lit(True).alias("taken"))
    # state: entities whose surrogate has been looked at and may still lose
    state = stage(entities.withColumn("attempt", F.lit(0)).withColumn(
        "new", _surrogate(key, F.col("kind"), F.col("form"), F.col("attempt"))), "surrogates")
    # a listed name's place is fixed, so it wins every tie; the others can move on
    order = F.struct((~_listed(F.col("kind"), F.col("form"))).cast("int").alias("late"), "attempt", "form")
    # ends: from FREE_FORM on each attempt has more values than the last, up to 64 keyed characters
    for n in count():
        # many entities draw the same listed value: the first of them comes from partial
        # minima, and a row of each value meets its entities
        best = stage(state.groupBy("kind", "new").agg(F.min(order)["form"].alias("best"))
                     .join(forms, ["kind", "new"], "left"), f"best{n}")
        judged = state.join(best, ["kind", "new"])
        # where a listed name is given out only uniqueness counts
        loses = (F.col("form") != F.col("best")) | (F.col("taken").isNotNull() & ~_listed(F.col("kind"), F.col("new")))
        judged = stage(judged.select("kind", "form", "attempt", "new", loses.alias("loses")), f"round{n}")
        if judged.where("loses").isEmpty():
            break
        # the next attempt is a column of its own first: an alias "attempt" beside the
        # surrogate would be read inside its lambdas in place of the input's column
        moved = judged.withColumn("next", F.when(F.col("loses"), F.col("attempt") + 1).otherwise(F.col("attempt")))
        drawn = F.when(F.col("loses"), _surrogate(key, F.col("kind"), F.col("form"), F.col("next"))).otherwise(F.col("new"))
        state = moved.select("kind", "form", F.col("next").alias("attempt"), drawn.alias("new"))
    return state.where("attempt > 0").select("kind", "form", "attempt")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, plus ``n_entities`` (mentions, bare names among them).

    All other columns are handed through unchanged. A null or empty text stays
    as it is, with no entities; repeated rows get the same replacements; an
    input column named n_entities is overwritten.
    """
    # the input's columns go through under numbers, so that no name of theirs can clash
    rest = [c for c in docs.columns if c not in ("text", "n_entities")]
    found = _found(docs.select(F.col("text").cast("string").alias("text"),
                               *[F.col(f"`{c}`").alias(f"in{k}") for k, c in enumerate(rest)]))
    changed = stage(changed_attempts(found, key), "changed")
    none = F.lit(None).cast("map<string,int>")
    if changed.isEmpty():
        found = found.withColumn("_fix", none)
    else:
        # documents that hold such an entity, by digest of their text, with the attempts they need
        digest = F.sha2(F.col("text"), 256)
        holders = (found.where("_parsed IS NOT NULL").select(
            digest.alias("_digest"), F.explode(F.array_distinct(F.flatten("_parsed.units"))).alias("u"))
            .select("_digest", "u.kind", "u.form").distinct().join(changed, ["kind", "form"])
            .groupBy("_digest").agg(F.map_from_entries(F.collect_list(F.struct(
                _entity_key(F.col("kind"), F.col("form")), "attempt"))).alias("_fix")))
        holders = stage(holders, "holders")
        if holders.count() <= BROADCAST_ROWS:
            holders = F.broadcast(holders)
        found = found.withColumn("_digest", digest).join(holders, "_digest", "left").drop("_digest")

    def attempt(u: Column) -> Column:
        return F.when(F.col("_fix").isNull(), F.lit(0)).otherwise(
            F.coalesce(F.try_element_at("_fix", _entity_key(u["kind"], u["form"])), F.lit(0)))

    def replaced(u: Column, token: Column) -> Column:
        return _let(attempt(u), lambda n: _let(
            _surrogate(key, u["kind"], u["form"], n), lambda s: _write(token, s, n)))

    def rewrite(p: Column) -> Column:
        new = F.transform(p["units"], lambda u, i: replaced(u, F.get(p["tokens"], i)))
        return F.concat(p["prefix"], F.array_join(new, " "))

    def bare(word: Column) -> Column:
        # a token of several kinds in one document: the first one's
        return _let(F.try_element_at("_names", word), lambda u: replaced(u, word))

    def between(g: Column) -> Column:
        return F.array_join(F.transform(g["pieces"], lambda x, i: F.concat(
            x, F.when(i < F.size(g["words"]), _let(F.get(g["words"], i), bare)).otherwise(""))), "")

    pieces = F.transform("_gaps", lambda g, i: F.concat(
        between(g), F.when(i < F.size("_parsed"), _let(F.element_at("_parsed", i + 1), rewrite)).otherwise("")))
    text = F.when(F.col("_parsed").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    n = F.size("_parsed") + F.aggregate("_gaps", F.lit(0), lambda acc, g: acc + F.size(g["words"]))
    n = F.when(F.col("_parsed").isNull(), 0).otherwise(n).cast("long")
    return found.select(*[F.col(f"in{k}") for k in range(len(rest))], text.alias("_text"), n.alias("_n")).toDF(
        *rest, "text", "n_entities")
