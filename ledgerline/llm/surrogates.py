"""Personal data: detection and keyed surrogates, with DataFrame functions only.

Entities are found by one pattern: e-mail addresses, assigned secrets, access keys, bank accounts, card, social security and
phone numbers, IP addresses, and names after a title. Each is cut into atoms (a name has a given name and a family
name), and an atom gets a surrogate drawn from a keyed hash:

* type and format: digits stay digits in the same grouping, letters stay letters of the same case, hexadecimal stays
  hexadecimal, a card number keeps its first digit and stays valid (or invalid) by its check digit, a phone number keeps its
  country digit;
* gender and script: a given name's surrogate has an ending of the gender that the title tells, names are spelled in
  the script of the original;
* coreference: one atom has one surrogate in the whole corpus, whatever its letter case or grouping (``Mr Ada Hill`` and
  ``Mr Hill``, ``+1 (469) 555-8958`` and ``+1-469-555-8958``);
* distinctness: two atoms of a kind never share a surrogate, and no surrogate is an atom found in the corpus; the losers of
  such a collision are drawn again until none is left.

A phone number with a country code ends where its country's number of digits is reached (``_FIXED``). In other countries it has
at most 15 digits and ends before an IP address, card, social security or dotted number; a plain number that follows it after
a space counts as its last group as far as 15 digits allow, since nothing tells them apart.

Scale: atoms are aggregated to distinct ones before anything is joined, so a hot entity is one row; occurrences are joined
to surrogates by key, where a hot key can be split. Per-document maps are bounded by the document. Only texts that hold an
entity are shuffled, to meet their map; the others pass through. Surrogates are drawn once an atom and round, in tasks of
``ATOMS_A_TASK`` atoms, as drawing costs far more than an atom's few bytes tell.

Defined results: a null text stays null and an empty one empty; repeated rows are rewritten alike; a null ``doc_id`` is kept.
All columns of the input are returned; ``text`` is replaced (and ``n_chars``, where there is such a column, follows it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import save

KEY = "ledgerline-surrogates-1"  # the default secret; callers pass their own
LONGER_AFTER = 16  # draws after which a surrogate may be longer than its atom, where a kind's space is exhausted
ATOMS_A_TASK = 2000

_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # a group that gives nothing back needs no stack
_ASSIGNED = r"""(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}["']?"""
_SECRET = r"(?<![A-Za-z0-9_])" + _ASSIGNED + r"[A-Za-z0-9_+/-]{8,}+"
_ACCESS = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_CARD = r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}(?![A-Za-z0-9])"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9])"
_IP = r"(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![A-Za-z0-9]|\.[0-9])"
_GAP = r"[ .()-]{0,3}"
#: Digits after the country code, where a country has one number of them.
_FIXED = {10: "1|7|30|44|52|90|91", 9: "27|31|33|34|41|48|61|351|380|420", 8: "45|47|65|852"}
_NATIONAL = "|".join(rf"(?<=\+(?:{codes})(?: ?\(0\))?{n * f'{_GAP}[0-9]'})" for n, codes in _FIXED.items())
_AREA = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})"
_GROUP = rf"(?:[.-]?[0-9]{{2,4}}| (?!{_IP})[0-9]{{2,4}})"
#: As above, and after a space no card, social security or dotted number is begun.
_PLAIN_GROUP = rf"(?:[.-]?[0-9]{{2,4}}| (?!{_IP}|{_CARD}|{_SSN}|[0-9]++\.[0-9])[0-9]{{2,4}})"
_LONGEST = rf"(?<!{15 * f'[0-9]{_GAP}'}[0-9])"
#: First a number of just its country's length; then one of at most 15 digits that spares the next number, else any.
_PHONE = (
    rf"{_AREA}{_GROUP}{{2,4}}(?![A-Za-z0-9])(?:{_NATIONAL})"
    rf"|{_AREA}{_PLAIN_GROUP}{{2,4}}(?![A-Za-z0-9]){_LONGEST}|{_AREA}{_GROUP}{{2,4}}(?![A-Za-z0-9]){_LONGEST}"
    r"|\+[0-9]{16,23}(?![A-Za-z0-9])"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![A-Za-z0-9])|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![A-Za-z0-9])"
)
_TITLE_F = r"(?:Mrs|Ms|Miss|Mme|Madame|Frau|Sra|Señora|г-жа|Госпожа|госпожа)"
_TITLE_M = r"(?:Mr|Monsieur|Herr|Sr|Señor|г-н|Господин|господин)"
_TITLE = rf"(?:{_TITLE_F}|{_TITLE_M}|Dr|Prof)\.? "
_TOKEN = r"\p{Lu}[\p{L}'-]*+"
_NAME = rf"(?<![\p{{L}}\p{{N}}]){_TITLE}{_TOKEN}(?: {_TOKEN})?"
#: Alternatives in order of precedence; the look-ahead spares letters the number patterns.
ENTITY = rf"{_EMAIL}|{_SECRET}|{_ACCESS}|{_IBAN}|(?<![A-Za-z0-9.+])(?=[0-9+(])(?:{_CARD}|{_SSN}|{_IP}|{_PHONE})|{_NAME}"

#: Syllables of surrogate names, and endings by gender.
_SYLLABLES = {
    "latin": ["ba", "be", "do", "fa", "ge", "ha", "jo", "ka", "le", "li", "ma", "mi", "na", "no", "pe", "ra", "ro", "sa", "te", "vi"],
    "cyrillic": ["ба", "ве", "го", "да", "же", "за", "ки", "ла", "ле", "ма", "ми", "на", "но", "пе", "ра", "ро", "са", "те", "фе", "ша"],
    "greek": ["βα", "γε", "δα", "ζω", "θε", "κα", "λα", "λε", "μα", "μι", "να", "νο", "πε", "ρα", "ρο", "σα", "τε", "φα", "χα", "ψη"],
}
_ENDINGS = {
    "latin": {"f": "la", "m": "ton", "n": "de", "s": "man"},
    "cyrillic": {"f": "на", "m": "мир", "n": "ле", "s": "ов"},
    "greek": {"f": "να", "m": "νος", "n": "λι", "s": "δης"},
}


def kind_of(match: Column) -> Column:
    """The kind of an entity, by the same patterns and precedence."""

    def whole(pattern: str) -> Column:
        return match.rlike(rf"^(?:{pattern})$")

    return (
        F.when(match.contains("@"), "email")
        .when(match.rlike(rf"^{_ASSIGNED}"), "secret")
        .when(whole(_ACCESS), "access")
        .when(whole(_IBAN), "iban")
        .when(whole(_CARD), "card")
        .when(whole(_SSN), "ssn")
        .when(whole(_IP), "ip")
        .when(whole(_PHONE), "phone")
        .otherwise("name")
    )


def entities(text: Column) -> Column:
    """All entities of a text, in order."""
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def _prefix(match: Column, kind: Column) -> Column:
    """What of an entity stays as it is: a title, or the name of an assigned secret."""
    return (
        F.when(kind == "name", F.regexp_extract(match, rf"^({_TITLE})", 1))
        .when(kind == "secret", F.regexp_extract(match, rf"^({_ASSIGNED})", 1))
        .otherwise("")
    )


def atoms(match: Column) -> Column:
    """The parts of an entity that get surrogates, in order: ``kind``, ``canon`` and ``form`` (as written)."""
    kind = kind_of(match)
    rest = F.substring(match, F.length(_prefix(match, kind)) + 1, F.length(match))
    names = F.split(rest, " ")
    gender = F.when(match.rlike(rf"^{_TITLE_F}\b"), "f").when(match.rlike(rf"^{_TITLE_M}\b"), "m").otherwise("n")

    def atom(kind: Column, canon: Column, form: Column) -> Column:
        return F.struct(kind.alias("kind"), canon.alias("canon"), form.alias("form"))

    family = atom(F.lit("family"), F.lower(F.element_at(names, -1)), F.element_at(names, -1))
    given = atom(F.concat(F.lit("given_"), gender), F.lower(names[0]), names[0])
    digits = F.regexp_replace(rest, "[^0-9]", "")
    canon = (
        F.when(kind.isin("card", "ssn", "phone"), digits)
        .when(kind == "email", F.lower(rest))
        .when(kind == "iban", F.replace(rest, F.lit(" "), F.lit("")))
        .otherwise(rest)
    )
    return F.when(kind == "name", F.when(F.size(names) > 1, F.array(given, family)).otherwise(F.array(family))).otherwise(
        F.array(atom(kind, canon, rest))
    )


def _pick(seed: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(seed, i), F.lit(n)).cast("int")


def _each(text: Column, change) -> Column:
    """``text`` with ``change(character, place)`` for each of its characters."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.when(F.length(text) == 0, "").otherwise(
        F.array_join(F.transform(places, lambda i: change(F.substring(text, i, F.lit(1)), i)), "")
    )


def _substituted(text: Column, seed: Column) -> Column:
    """Digits for digits, letters for letters of the same case."""
    return _each(
        text,
        lambda ch, i: F.when(ch.between("0", "9"), _pick(seed, i, 10).cast("string"))
        .when(ch.between("a", "z"), F.char(_pick(seed, i, 26) + 97))
        .when(ch.between("A", "Z"), F.char(_pick(seed, i, 26) + 65))
        .otherwise(ch),
    )


def _check_sum(digits: Column) -> Column:
    """Sum of a digit string by the card rule (every second digit from the right, the last excepted, counts double)."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(F.pmod(n - i, F.lit(2)) == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda total, i: total + worth(i))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str = KEY) -> Column:
    """The candidate for an atom at a draw."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")), 256)
    more = F.greatest(F.lit(0), attempt - LONGER_AFTER)  # extra characters
    tail = F.when(more > 0, F.substring(F.regexp_replace(seed, "[^0-9]", ""), F.lit(1), more)).otherwise("")
    plain = F.concat(_substituted(canon, seed), tail)

    first = F.substring(canon, 1, 1)
    phone = F.when(F.length(canon) > 10, F.concat(first, F.substring(plain, 2, 1 << 20))).otherwise(plain)
    stem = F.concat(first, F.substring(plain, F.lit(2), F.length(plain) - 2), F.lit("0"))
    check = F.pmod(-_check_sum(stem), F.lit(10))
    valid = F.pmod(_check_sum(canon), F.lit(10)) == 0
    card = F.concat(
        F.substring(stem, F.lit(1), F.length(stem) - 1), F.when(valid, check).otherwise(F.pmod(check + 1, F.lit(10))).cast("string")
    )
    hexadecimal = F.concat(
        _each(
            canon,
            lambda ch, i: F.when(
                canon.rlike("^[0-9a-f]+$"), F.substring(F.lit("0123456789abcdef"), _pick(seed, i, 16) + 1, F.lit(1))
            ).otherwise(F.substring(F.lit("0123456789ABCDEF"), _pick(seed, i, 16) + 1, F.lit(1))),
        ),
        tail,
    )
    host = F.concat(F.lit("mail"), F.pmod(F.xxhash64(F.lit(key), F.substring_index(canon, "@", -1)), F.lit(10**6)), F.lit(".example.net"))
    email = F.concat(_substituted(F.substring_index(canon, "@", 1), seed), tail, F.lit("@"), host)
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_pick(seed, i, 254) + 1).cast("string")), ".")
    iban = F.concat(F.substring(canon, 1, 2), F.substring(plain, 3, 1 << 20))
    access = F.concat(F.substring(canon, 1, 4), F.substring(plain, 5, 1 << 20))

    def name(script: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[script]))
        ends = _ENDINGS[script]
        end = F.when(kind == "given_f", ends["f"]).when(kind == "given_m", ends["m"]).when(kind == "given_n", ends["n"]).otherwise(ends["s"])
        places = F.sequence(F.lit(1), F.lit(3) + more)
        body = F.array_join(F.transform(places, lambda i: F.element_at(syllables, _pick(seed, i, 20) + 1)), "")
        return F.concat(body, end)

    return (
        F.when(kind == "email", email)
        .when(kind == "secret", F.when(canon.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), hexadecimal).otherwise(plain))
        .when(kind == "access", access)
        .when(kind == "iban", iban)
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when(kind == "ip", ip)
        .when(kind == "ssn", plain)
        .when(canon.rlike(r"\p{IsCyrillic}"), name("cyrillic"))
        .when(canon.rlike(r"\p{IsGreek}"), name("greek"))
        .otherwise(name("latin"))
    )


def _laid(digits: Column, form: Column) -> Column:
    """``digits`` in the places that ``form`` has digits at; what is left over follows."""
    count = F.length(F.regexp_replace(form, "[^0-9]", ""))
    laid = _each(
        form,
        lambda ch, i: F.when(
            ch.between("0", "9"),
            F.substring(digits, F.length(F.regexp_replace(F.substring(form, F.lit(1), i), "[^0-9]", "")), F.lit(1)),
        ).otherwise(ch),
    )
    return F.concat(laid, F.substring(digits, count + 1, F.length(digits)))


def styled(kind: Column, found: Column, form: Column) -> Column:
    """A surrogate as its original was written: grouping and letter case."""
    upper = (F.upper(form) == form) & (F.lower(form) != form)
    named = F.when(upper & (F.length(form) > 1), F.upper(found)).otherwise(F.initcap(found))
    spaced = F.when(form.contains(" "), F.rtrim(F.regexp_replace(found, "(.{4})", "$1 "))).otherwise(found)
    return (
        F.when(kind.isin("card", "ssn", "phone"), _laid(found, form))
        .when(kind == "email", F.when(upper, F.upper(found)).otherwise(found))
        .when(kind == "iban", spaced)
        .when(kind.isin("secret", "access", "ip"), found)
        .otherwise(named)
    )


def distinct_surrogates(known: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, canon, surrogate`` of every atom (``kind, canon``, distinct), no two alike within a kind and none of
    them an atom itself. Of those that draw the same, the smallest keeps it and the others draw again."""
    known = save(known, "atoms")
    taken, waiting, attempt = None, known, 0
    tasks = known.count() // ATOMS_A_TASK + 1
    while True:
        spread = waiting.repartition(tasks, "kind", "canon")
        drawn = save(spread.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), F.lit(attempt), key)), "drawn")
        least = drawn.groupBy(F.col("kind").alias("k"), F.col("surrogate").alias("s")).agg(F.min("canon").alias("keeper"))
        real = known.select(F.col("kind").alias("k"), F.col("canon").alias("s"))
        free = least.join(real, ["k", "s"], "left_anti")
        if taken is not None:
            free = free.join(taken.select(F.col("kind").alias("k"), F.col("surrogate").alias("s")), ["k", "s"], "left_anti")
        same = (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")) & (F.col("canon") == F.col("keeper"))
        kept = drawn.join(free, same, "left_semi")
        now = save(kept if taken is None else taken.unionByName(kept), "surrogates")
        waiting = known.join(now.select("kind", "canon"), ["kind", "canon"], "left_anti")
        taken, attempt = now, attempt + 1
        left = waiting.count()
        if left == 0:
            return taken
        tasks = left // ATOMS_A_TASK + 1


def _uid() -> Column:
    return F.xxhash64("doc_id", "text")


def find(docs: DataFrame) -> DataFrame:
    """``uid, match`` of every entity, once a document row."""
    rows = docs.select(_uid().alias("uid"), F.array_distinct(entities(F.col("text"))).alias("matches"))
    return rows.filter(F.size("matches") > 0)


def replacements(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``uid, swaps``: for each document row with entities, the map from entity to replacement."""
    found = save(find(docs), "entities")
    parts = (
        found.select("uid", F.explode("matches").alias("match"))
        .distinct()
        .select("uid", "match", F.posexplode(atoms(F.col("match"))).alias("place", "atom"))
        .select("uid", "match", "place", "atom.kind", "atom.canon", "atom.form")
    )
    known = distinct_surrogates(parts.select("kind", "canon").distinct(), key)
    swapped = parts.join(known, ["kind", "canon"]).withColumn("new", styled(F.col("kind"), F.col("surrogate"), F.col("form")))
    whole = swapped.groupBy("uid", "match").agg(F.sort_array(F.collect_list(F.struct("place", "new"))).alias("parts"))
    kind = kind_of(F.col("match"))
    whole = whole.withColumn("new", F.concat(_prefix(F.col("match"), kind), F.array_join("parts.new", " ")))
    return whole.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("match", "new"))).alias("swaps"))


def rewrite(text: Column, swaps: Column) -> Column:
    """``text`` with each entity replaced by its value in ``swaps``."""
    new = F.transform(entities(text), lambda m: F.element_at(swaps, m))
    pieces = F.split(text, ENTITY, -1)
    return F.array_join(F.zip_with(pieces, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def pseudonymise(docs: DataFrame, key: str = KEY, count_as: str | None = None) -> DataFrame:
    """All columns of ``docs`` with the personal data in ``text`` replaced; ``count_as`` names a further column, the
    number of different entities of a row."""
    found = save(replacements(docs, key), "swaps")
    swaps = F.col("found.swaps")
    held = F.coalesce(F.col("text").rlike(ENTITY), F.lit(False))
    on = F.xxhash64("d.doc_id", "d.text") == F.col("found.uid")
    joined = docs.filter(held).alias("d").join(found.alias("found"), on)
    text = rewrite(F.col("d.text"), swaps)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    changed = [new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns]
    same = [F.col(f"`{c}`") for c in docs.columns]
    if count_as:
        changed.append(F.size(swaps).alias(count_as))
        same.append(F.lit(0).alias(count_as))
    return joined.select(*changed).union(docs.filter(~held).select(*same))
