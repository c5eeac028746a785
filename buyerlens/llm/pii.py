"""Surrogates for personal data, with DataFrame functions only.

Detected entities are replaced by keyed ones of the same type and layout: the
same entity (case and separators aside) has one surrogate in the whole corpus,
different ones have different ones, and none is an original of the corpus. A
surrogate is a function of the key, the type, the entity and an attempt
number; the distinct entities are checked for collisions, and those that
collide (few: the layouts leave a wide choice) take the next attempt. A name
is detected by its form of address; its parts are replaced one by one, so that
a later mention of the family name alone agrees, from lists of the same gender
and script.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.llm.base import cut, unused

MALE = r"Mr|Herr|Monsieur|Señor|Sr|господин|г-н"
FEMALE = r"Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|госпожа|г-жа"
SECRET_NAME = r"(?i:token|api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|password|passwd|pwd)"
SECRET_VALUE = r"[A-Za-z0-9+/_=-]{8,}"
# Each starts with a look at one character, so that a place where it cannot match costs little.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "secret": rf"(?=[taspTASP])\b{SECRET_NAME}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?{SECRET_VALUE}|(?=[Asg])\b(?:AKIA[0-9A-Z]{{16}}\b"
              r"|sk-(?:(?=[A-Za-z0-9]{20})|(?=[a-z_-]*+[0-9A-Z]))[A-Za-z0-9_-]{20,}+|(?:gh[pousr]|github_pat)_[A-Za-z0-9_-]{20,}+)"
              r"|(?=[0-9a-fA-F]{8})\b(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{32,}+\b",
    "ip": r"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "phone": r"(?=\+)(?<![\w+])\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?=\()(?<!\w)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?=\d)(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?=\d)(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"(?=[A-Z]{2}\d)\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?=\d)(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)",
    "person": rf"(?=[MHSDFг])(?<!\p{{L}})(?:{MALE}|{FEMALE}|Dr)\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _possible(text: Column) -> Column:
    """False only where no pattern can match: each needs a digit, one of these marks, or a form of address and a space."""
    marks = ["@", "=", ":", "sk-", "gh", "github_pat_", "AKIA", *(f"{a}{end}" for a in f"{MALE}|{FEMALE}|Dr".split("|") for end in (" ", ". "))]
    out = text.rlike("[0-9]")
    for m in marks:
        out = out | text.contains(m)
    return out


def mentions(text: Column) -> Column:
    """All mentions of a text, in their order; none for a null one."""
    none = F.array().cast("array<string>")
    return F.when(_possible(text), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(none)


# Names that stand in, by gender and script, and the endings that a further attempt adds.
GIVEN = {
    ("male", "latin"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Kurt Leo Martin Noah Oscar Paul Robert Simon Thomas Victor",
    ("female", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nina Olga Paula Rosa Sofia Tina Vera",
    ("any", "latin"): "Alex Ariel Chris Dana Eli Jamie Jordan Kim Lee Lou Maxime Morgan Nicky Pat Robin Sam Sascha Sidney Taylor Toni",
    ("male", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим",
    ("female", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лидия Мария",
    ("any", "cyrillic"): "Саша Женя Валя Шура Слава",
}
FAMILY = {
    "latin": ("Alder Birch Cedar Dale Elm Field Grove Hill Irwin Juniper Knoll Lake Marsh North Oak Pine Quarry Ridge Stone Thorn",
              "berg brook burn by croft ford gate ham hurst land ley man mere mont quist son stad ton well wood"),
    "cyrillic": ("Берёз Волк Глад Дуб Жук Зим Ключ Лес Мороз Нов", "енко ин ов овский ский цев чук як"),
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hex(col: Column, i: Column) -> Column:
    """The i-th byte (from 0, in a ring of 64) of a 512-bit hex digest."""
    return F.conv(F.substring(col, (i % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(words: str, byte: Column) -> Column:
    names = words.split()
    return F.element_at(F.array(*[F.lit(n) for n in names]), byte % len(names) + 1)


def _is_upper(c: Column) -> Column:
    return (F.upper(c) == c) & (F.lower(c) != c)


def _chars(text: Column, digest: Column, hexed: Column) -> Column:
    """Every letter and digit replaced by one of its kind; other characters stay."""
    def one(c: Column, i: Column, of_hex: Column) -> Column:
        b = _hex(digest, i + F.floor(i / 64).cast("int") * 7)
        return (F.when(of_hex & c.rlike("[0-9a-f]"), F.lower(F.conv((b % 16).cast("string"), 10, 16)))
                .when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(c.rlike("[a-z]"), F.char(b % 26 + 97))
                .when(c.rlike("[A-Z]"), F.char(b % 26 + 65)).otherwise(c))

    # Split, and looked at as a whole, once: a character costs the same wherever it stands in a long text.
    return _let(hexed, lambda of_hex: F.array_join(F.transform(F.split(text, ""), lambda c, i: one(c, i, of_hex)), ""))


def kind_of(mention: Column) -> Column:
    """The type of a mention that :data:`ENTITY` matched."""
    out = F.when(mention.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    for name in ("ip", "phone", "ssn", "person", "secret", "iban"):
        out = out.when(mention.rlike(f"^(?:{PATTERNS[name]})$"), name)
    return out.otherwise("card")


def parts_of(mention: Column) -> Column:
    """The entities in a mention, ``array<struct<kind, norm>>``: one, but for a name of two words."""
    return _let(kind_of(mention), lambda kind: F.when(kind == "person", _name_parts(mention)).otherwise(
        F.array(_entity(kind, _normal(mention, kind)))))


def _entity(kind: Column, norm: Column) -> Column:
    return F.struct(kind.alias("kind"), norm.alias("norm"))


def _normal(mention: Column, kind: Column) -> Column:
    value = F.regexp_extract(mention, rf"({SECRET_VALUE})$", 1)
    return (F.when(kind == "email", F.lower(mention)).when(kind == "ip", mention)
            .when(kind == "secret", _let(value, lambda v: F.when(v.rlike("^[0-9a-fA-F]+$"), F.lower(v)).otherwise(v)))
            .when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(F.regexp_replace(mention, r"\D", "")))


def _name_parts(mention: Column) -> Column:
    address = F.regexp_extract(mention, r"^([^ .]+)", 1)
    gender = F.when(address.rlike(f"^(?:{MALE})$"), "male").when(address.rlike(f"^(?:{FEMALE})$"), "female").otherwise("any")

    def of(words: Column) -> Column:
        script = lambda c: F.when(c.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        family = lambda c: _entity(F.concat(F.lit("family "), script(c)), F.lower(c))
        given = lambda c: _entity(F.concat(F.lit("given "), gender, F.lit(" "), script(c)), F.lower(c))
        return F.when(F.size(words) > 2, F.array(given(words[1]), family(words[2]))).otherwise(F.array(family(words[1])))

    return _let(F.split(mention, " "), of)


def surrogate(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """The stand-in of a normalised entity."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm), 512)
    return _let(digest, lambda h: _surrogate(kind, norm, attempt, h))


def _surrogate(kind: Column, norm: Column, attempt: Column, h: Column) -> Column:
    hexed = (kind == "secret") & norm.rlike("^[0-9a-f]+$")
    domain = F.regexp_extract(norm, r"(\.[a-z0-9-]+)$", 1)
    octets = F.concat_ws(".", *[(_hex(h, F.lit(i)) % 254 + 1).cast("string") for i in range(4)])
    out = (F.when(kind == "email", F.concat(_chars(F.regexp_replace(norm, r"\.[a-z0-9-]+$", ""), h, F.lit(False)), domain))
           .when(kind == "ip", octets)
           .when(kind == "phone", F.concat(F.substring(norm, 1, 1), _chars(F.regexp_replace(norm, "^.", ""), h, F.lit(False))))
           .when(kind == "iban", F.concat(F.substring(norm, 1, 2), _chars(F.regexp_replace(norm, "^..", ""), h, F.lit(False)))))
    for (gender, script), names in GIVEN.items():
        more = F.when(attempt > 0, F.concat(F.lit("-"), _pick(names, _hex(h, F.lit(1))), F.when(
            attempt > 1, F.concat(F.lit("-"), _pick(names, _hex(h, F.lit(2))), F.when(
                attempt > 2, F.concat(F.lit("-"), _letters(h, attempt, script))).otherwise(""))).otherwise(""))).otherwise("")
        out = out.when(kind == f"given {gender} {script}", F.concat(_pick(names, _hex(h, F.lit(0))), more))
    for script, (stems, endings) in FAMILY.items():
        more = F.when(attempt > 0, F.concat(F.lit("-"), _pick(stems, _hex(h, F.lit(2))), _pick(endings, _hex(h, F.lit(3))), F.when(
            attempt > 1, F.concat(F.lit("-"), _letters(h, attempt, script))).otherwise(""))).otherwise("")
        out = out.when(kind == f"family {script}", F.concat(_pick(stems, _hex(h, F.lit(0))), _pick(endings, _hex(h, F.lit(1))), more))
    return out.otherwise(_chars(norm, h, hexed))


def _letters(h: Column, attempt: Column, script: str) -> Column:
    """A capitalised run of letters, longer from attempt to attempt."""
    base, n = (1072, 32) if script == "cyrillic" else (97, 26)
    letters = F.array(*[F.lit(chr(base + i)) for i in range(n)])
    return F.initcap(F.array_join(F.transform(F.sequence(F.lit(4), F.lit(6) + attempt), lambda i: F.element_at(letters, _hex(h, i) % n + 1)), ""))


def _fill(layout: Column, chars: Column) -> Column:
    """``chars`` one by one in the places of ``layout``'s letters and digits."""
    def one(i: Column) -> Column:
        c = F.substring(layout, i, F.lit(1))
        k = F.length(F.regexp_replace(F.substring(layout, F.lit(1), i), "[^A-Za-z0-9]", ""))
        return F.when(c.rlike("[A-Za-z0-9]"), F.substring(chars, k, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), one), "")


def _render(mention: Column, entities: Column, stand: Column) -> Column:
    """The text that replaces a mention, of the stand-ins of its entities."""
    kind = F.element_at(entities, 1)["kind"]
    first = F.element_at(stand, 1)
    value = F.regexp_extract(mention, rf"({SECRET_VALUE})$", 1)
    head = F.substring(mention, F.lit(1), F.length(mention) - F.length(value))
    upper = lambda c: F.when(_is_upper(mention), F.upper(c)).otherwise(c)
    return (F.when(kind.isin("email"), upper(first))
            .when(kind == "secret", F.concat(head, F.when(_is_upper(value), F.upper(first)).otherwise(first)))
            .when(kind.isin("phone", "card", "ssn", "iban"), _fill(mention, first))
            .when(kind == "ip", first)
            .otherwise(F.concat(F.regexp_extract(mention, r"^(\S+ )", 1), upper(F.array_join(stand, " ")))))


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct ``(kind, norm)`` of all texts."""
    found = docs.select(F.explode(mentions(F.col(text_col))).alias("m"))
    return found.select(F.inline(parts_of(F.col("m")))).distinct()


def exceptions(ents: DataFrame, key: str, rounds: int = 20) -> DataFrame | None:
    """``(kind, norm, attempt)`` of the entities whose first stand-ins collide; None if there are none.

    A stand-in that several entities share stays with the smallest of them; one
    that is an original stays with none. Each round moves the others on and
    checks everything again.
    """
    moved: DataFrame | None = None
    for _ in range(rounds):
        tried = ents.withColumn("attempt", F.lit(0)) if moved is None else ents.join(
            moved, ["kind", "norm"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        shape = F.regexp_replace("kind", r"^given \S+", "given")
        made = tried.select("kind", "norm", "attempt", shape.alias("space"),
                            F.lower(surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), key)).alias("s"))
        taken = ents.select(shape.alias("space"), F.lower("norm").alias("s"), F.lit(None).cast("string").alias("who"))
        claim = made.select("space", "s", F.concat_ws(" ", "kind", "norm").alias("who")).unionByName(taken)
        bad = claim.groupBy("space", "s").agg(F.count("who").alias("claims"), F.max(F.col("who").isNull()).alias("original"),
                                              F.min("who").alias("keeper")).where("claims > 1 or (claims = 1 and original)")
        lost = cut(made.join(bad, ["space", "s"]).where(F.col("original") | (F.concat_ws(" ", "kind", "norm") != F.col("keeper")))
                   .select("kind", "norm", (F.col("attempt") + 1).alias("attempt")))
        if lost.isEmpty():
            return moved
        kept = lost if moved is None else moved.join(lost, ["kind", "norm"], "left_anti").unionByName(lost)
        moved = cut(kept)
    raise RuntimeError(f"stand-ins still collide after {rounds} rounds")


def _replaced(text: Column, found: Column, attempt_of) -> Column:
    def stand(m: Column) -> Column:
        return _let(parts_of(m), lambda parts: _let(F.transform(parts, attempt_of), lambda new: _render(m, parts, new)))

    pieces = F.split(text, ENTITY, -1)
    joined = F.zip_with(pieces, F.transform(found, stand), lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    return F.when(F.size(found) > 0, F.array_join(joined, "")).otherwise(text)


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with every entity of ``text_col`` replaced; ``count_col``, if named, gets the number of mentions.

    One pass finds the distinct entities, one replaces them; only if some
    collide do their texts' attempts come by a join (on the text's hash, so
    null and repeated ids do not matter). Null texts stay null, empty ones
    empty; other columns and repeated rows stay as they are, whatever their
    names; a ``count_col`` that the table has already is refused.
    """
    if count_col in docs.columns:
        raise ValueError(f"the table has a column {count_col} already")
    c_found, c_hash, c_moved = (unused(docs, n) for n in ("__found", "__h", "__moved"))
    moved = exceptions(cut(entities(docs, text_col)), key)
    found = mentions(F.col(text_col))
    out = docs.withColumn(c_found, found)
    if moved is None:
        new = _replaced(F.col(text_col), F.col(c_found), lambda e: surrogate(e["kind"], e["norm"], F.lit(0), key))
    else:
        own = (docs.select(F.xxhash64(text_col).alias(c_hash), F.explode(found).alias("m"))
               .select(c_hash, F.inline(parts_of(F.col("m")))).distinct().join(moved, ["kind", "norm"])
               .groupBy(c_hash).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws(" ", "kind", "norm"), "attempt"))).alias(c_moved)))
        out = out.withColumn(c_hash, F.xxhash64(text_col)).join(own, c_hash, "left")
        attempt = lambda e: F.coalesce(F.element_at(c_moved, F.concat_ws(" ", e["kind"], e["norm"])), F.lit(0))
        new = _replaced(F.col(text_col), F.col(c_found), lambda e: surrogate(e["kind"], e["norm"], attempt(e), key))
    cols = [new.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    if count_col:
        cols.append(F.size(c_found).alias(count_col))
    return out.select(*cols)
