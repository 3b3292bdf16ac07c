"""PII surrogates, in DataFrame and SQL functions only.

Entities (mail and IP addresses, phone, card, account and social security numbers,
keys and passwords, names after a form of address) are found by one pattern, each to the
end of its token: secrets and addresses of any length, names of up to twelve words with
initials, particles, hyphens and apostrophes. Names without a form of address are not found.
Every distinct entity of the corpus gets one replacement, so mentions stay together:

* keyed: it follows from the key and the entity, through SHA-256. The key has no default:
  whoever has it can redo the replacement. It is read from a one-row table by a scalar
  subquery, so that no plan and no event log shows it;
* of its type: letters stay letters of their case and script, digits digits, separators where
  they are; particles of names stay; an octet stays one; check digits of cards and accounts stay right where they
  were; a name keeps its form of address and gets one of the same gender and script;
* the same wherever a part recurs: each part of a name and each domain is an entity of
  its own with its own table, so "Mr Smith", "Mrs Smith" and "Mr John Smith" share a
  surname and all addresses of a domain share one;
* distinct: replacements that meet each other or anything of their kind in the corpus
  are drawn again until none does; names and domains grow by a syllable or a letter
  with further draws, so there is always one left.

Phone numbers are found in international form, in North American form, in French form
(five pairs of digits), in German form (area code from 0, then five digits or more), and in
British form (0 and ten digits in three groups); national numbers of other forms are too
like plain numbers to tell.

Texts without a digit, an @, = or : or a form of address are passed by. Others meet their
replacements by a hash of the text; large groups of copies are split by adaptive
skew joins.

Results for odd input: null and empty texts stay as they are; ids are not used, so
null and repeated ones do not matter; repeated rows each get the same result; an
empty table gives no rows. All columns of the input are kept, whatever their names; with
details one called _entities gives way to the added one.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm._scratch import discard, persist

#: Forms of address, by gender.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"]
NEUTRAL = ["Dr", "Prof"]
#: Syllables of names by script, and how they end by gender.
SYLLABLES = {
    "latin": "ba be bi da de di fa fe ga ge ha he ja ka ke la le li ma me mi na ne ni pa pe ra re ri sa se si ta te ti va ve vi wa we".split(),
    "cyrillic": "ба бе ви да де ди га ге за зе ка ке ла ле ли ма ме ми на не ни па пе ра ре ри са се та те ти".split(),
    "greek": "βα βε δα δε δι γα γε κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε σα σε τα τε τι".split(),
}
#: By script: endings of first names (male, female) and of surnames (male, female).
ENDINGS = {"latin": ("rdo", "lina", "s", "s"), "cyrillic": ("слав", "лина", "н", "на"), "greek": ("δης", "λια", "ς", "")}

_TITLE = "|".join([*MALE, *FEMALE, *NEUTRAL])
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Forms of phone numbers: North American, international, French, German.
_PHONES = [
    r"(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}",
    r"\+(?=(?:[ .\-/()]{0,2}\d){8,15}(?!\d))[1-9]\d{0,2}(?:[ .\-/]?\(?\d{1,6}\)?){2,6}",
    r"0[1-9](?:[ .]\d{2}){4}",
    r"0[1-9]\d{1,3}[ /]\d{5,8}",
    r"\(?0[1-9]\d{1,3}\)?[ -]\d{3,4}[ -]\d{3,4}",
]
#: Particles of names, which stay.
PARTICLES = "van von vom de der den del della di da dos das du des la le ter ten zu zur zum bin ibn al el af av".split()
_LETTER = r"[\p{L}\p{M}]"
_WORD = rf"(?:\p{{Lu}}['’])?\p{{Lu}}{_LETTER}++(?:['’-]\p{{L}}{_LETTER}++)*+"
_BEFORE = rf"(?:(?:\p{{Lu}}\. ?|(?:{'|'.join(PARTICLES)}) |[dl]['’](?=\p{{Lu}}))){{0,6}}"
_HEX = r"[0-9A-Fa-f]{1,4}"
#: All eight groups, or fewer around a double colon, with a digit somewhere.
_IPV6 = rf"(?<![\w:.])(?=[0-9A-Fa-f:]{{2,39}}(?![\w:]))(?=[A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\w:])"
_MAIL = r"[\p{L}\p{M}\p{N}._%+-]++@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]++)++"
#: Alternatives in order of preference. Each starts where a token does, so that long tokens are not tried again at each letter.
PATTERN = "|".join(
    [
        r"(?<=(?i:password|passwd|pwd|token|secret|api_key|apikey)\s{0,2}[=:]\s{0,2}[\"']?)[\p{L}\p{N}+/_$!#%*.~^&-][^\s\"'<>,;]{6,}[\p{L}\p{N}+/_=$!#%*~^&-]",
        rf"(?<![\p{{L}}\p{{M}}\p{{N}}._%+-]){_MAIL}",
        rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
        _IPV6,
        r"(?<![\w-])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![\w-])",
        r"(?<![\w-])3[47]\d{2}([ -]?)\d{6}\2\d{5}(?![\w-])",
        rf"(?<![\w+.])(?:{'|'.join(_PHONES)})(?!\w)",
        r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
        r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
        r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)",
        rf"(?<!\p{{L}})(?:{_TITLE})\.? {_BEFORE}{_WORD}(?: {_BEFORE}{_WORD}){{0,11}}+(?!{_LETTER})",
    ]
)
#: Every entity but a name has one of these in it or before it.
MARKS = "[0-9@=:]"
NAME = rf"^(?:{_TITLE})\.? "
KINDS = ("email", "ip", "ip6", "card", "phone", "ssn", "iban", "key", "person", "secret")


def kind_of(e: Column) -> Column:
    """Type of an entity that the pattern found."""
    rules = [
        ("email", rf"^{_MAIL}$"),
        ("ip", rf"^{_OCTET}(\.{_OCTET}){{3}}$"),
        ("ip6", rf"^(?=.*:.*:)[0-9A-Fa-f:]+$"),
        ("card", r"^(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}|3[47]\d{2}([ -]?)\d{6}\2\d{5})$"),
        ("phone", rf"^(?:{'|'.join(_PHONES)})$"),
        ("ssn", r"^\d{3}-\d{2}-\d{4}$"),
        ("key", r"^AKIA[0-9A-Z]{16}$"),
        ("iban", r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}"),
        ("person", NAME),
    ]
    out = F.lit("secret")
    for name, rule in reversed(rules):
        out = F.when(e.rlike(rule), name).otherwise(out)
    return out


def _draw(seed: Column, i: Column) -> Column:
    """The i-th number from 0 to 255 that follows from the seed."""
    block = F.sha2(F.concat(seed, F.lit("#"), (F.floor(i / 32)).cast("string")), 256)
    return F.conv(F.substr(block, (i % 32 * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _turn(c: Column, first: str, n: int, k: Column) -> Column:
    return F.char((F.ascii(c) - ord(first) + k) % n + ord(first))


#: Letters that stand for letters of other scripts than the basic Latin one.
OTHER_LETTERS = {"IsCyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "IsGreek": "αβγδεζηθικλμνξοπρστυφχψω", "L": "abcdefghijklmnopqrstuvwxyz"}


def scramble(s: Column, seed: Column) -> Column:
    """s with each letter or digit turned by what the seed says; hex stays hex. Letters beyond A to Z become some of their script, or Latin ones."""
    is_hex, is_upper_hex = s.rlike("^[0-9a-f:]+$"), s.rlike("^[0-9A-F:]+$")

    def other(c: Column, k: Column) -> Column:
        out = c
        for script, letters in reversed(OTHER_LETTERS.items()):
            own = F.substr(F.lit(letters), k % len(letters) + 1, F.lit(1))
            out = F.when(c.rlike(rf"\p{{{script}}}"), F.when(c.rlike(r"\p{Lu}"), F.upper(own)).otherwise(own)).otherwise(out)
        return out

    def one(c: Column, i: Column) -> Column:
        k = _draw(seed, i)
        return (
            F.when(c.between("0", "9"), _turn(c, "0", 10, k))
            .when(is_hex & c.between("a", "f"), _turn(c, "a", 6, k))
            .when(is_upper_hex & c.between("A", "F"), _turn(c, "A", 6, k))
            .when(c.between("a", "z"), _turn(c, "a", 26, k))
            .when(c.between("A", "Z"), _turn(c, "A", 26, k))
            .when(F.ascii(c) > 127, other(c, k))
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(s), one), "")


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def luhn_digit(digits: Column) -> Column:
    """Check digit of a string of digits."""
    reverse = F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return ((10 - F.aggregate(reverse, F.lit(0), lambda a, x: a + x) % 10) % 10).cast("string")


def _card(e: Column, seed: Column) -> Column:
    """The first digit, both for 15 digits, and separators stay; the check digit is right if it was."""
    digits = F.regexp_replace(e, "[^0-9]", "")
    n = F.length(digits)
    kept = F.when(n == 15, 2).otherwise(1)
    valid = luhn_digit(F.substr(digits, F.lit(1), n - 1)) == F.substr(digits, n, F.lit(1))
    body = F.concat(F.substr(digits, F.lit(1), kept), scramble(F.substr(digits, kept + 1, n - 1 - kept), seed))
    new = F.concat(body, F.when(valid, luhn_digit(body)).otherwise(scramble(F.substr(digits, n, F.lit(1)), seed)))
    before = lambda i: F.length(F.regexp_replace(F.substr(e, F.lit(1), i + 1), "[^0-9]", ""))
    return F.array_join(F.transform(_chars(e), lambda c, i: F.when(c.between("0", "9"), F.substr(new, before(i), F.lit(1))).otherwise(c)), "")


def mod97(text: Column) -> Column:
    """Remainder modulo 97 of a text of digits and capitals, which stand for 10 to 35."""
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(text), F.lit(0), lambda r, c: (r * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def _iban(e: Column, seed: Column) -> Column:
    """Country, separators and classes stay; check digits are right if they were."""
    bare = F.replace(e, F.lit(" "), F.lit(""))
    country = F.substr(e, F.lit(1), F.lit(2))
    valid = mod97(F.concat(F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(4)))) == 1
    rest = scramble(F.substr(e, F.lit(5), F.length(e)), seed)
    check = F.lpad((98 - mod97(F.concat(F.replace(rest, F.lit(" "), F.lit("")), country, F.lit("00")))).cast("string"), 2, "0")
    plain = scramble(F.substr(e, F.lit(3), F.lit(2)), F.concat(seed, F.lit("check")))
    return F.concat(country, F.when(valid, check).otherwise(plain), rest)


def _phone(e: Column, seed: Column) -> Column:
    """The country code, or the 0 of an area code, stays."""
    head = F.regexp_extract(e, r"^(\+\d{1,3}[ .\-/]?|\(?0)", 0)
    return F.concat(head, scramble(F.substr(e, F.length(head) + 1, F.length(e)), seed))


def _script(w: Column) -> Column:
    return F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _by_script(script: Column, of: Callable[[str], Column]) -> Column:
    return F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin"))


def _grown(c: Column, attempt: Column, free: int) -> Column:
    """c, longer by a letter for each draw after the first `free`."""
    return F.concat(c, F.repeat(F.lit("a"), F.greatest(attempt - free, F.lit(0))))


def name_stem(word: Column, attempt: Column, seed: Column) -> Column:
    """Three syllables, one more with each further draw."""

    def of(script: str) -> Column:
        parts = F.array(*map(F.lit, SYLLABLES[script]))
        some = F.transform(F.sequence(F.lit(0), attempt + 2), lambda i: F.element_at(parts, _draw(seed, i) % len(SYLLABLES[script]) + 1))
        return F.array_join(some, "")

    return _by_script(_script(word), of)


def name_forms(word: Column, stem: Column, last: Column) -> Column:
    """Male and female form."""
    return _by_script(_script(word), lambda s: F.when(last, F.array(F.concat(stem, F.lit(ENDINGS[s][2])), F.concat(stem, F.lit(ENDINGS[s][3])))).otherwise(F.array(F.concat(stem, F.lit(ENDINGS[s][0])), F.concat(stem, F.lit(ENDINGS[s][1])))))


def domain_surrogate(domain: Column, attempt: Column, seed: Column) -> Column:
    """Of a domain in lower case; its last part stays."""
    top = F.substring_index(domain, ".", -1)
    rest = F.substr(domain, F.lit(1), F.length(domain) - F.length(top) - 1)
    return F.concat(scramble(_grown(rest, attempt, 4), seed), F.lit("."), top)


def surrogate(e: Column, kind: Column, attempt: Column, domain: Column, seed: Column) -> Column:
    """Replacement of an entity that is no name at a given attempt; domain: that of an address, replaced."""
    octets = F.array_join(F.transform(F.split(e, r"\."), lambda o, i: ((o.cast("int") + _draw(seed, i)) % 256).cast("string")), ".")
    return (
        F.when(kind == "email", F.concat(scramble(_grown(F.substring_index(e, "@", 1), attempt, 4), seed), F.lit("@"), domain))
        .when(kind == "ip", octets)
        .when(kind == "card", _card(e, seed))
        .when(kind == "phone", _phone(e, seed))
        .when(kind == "key", F.concat(F.lit("AKIA"), scramble(F.substr(e, F.lit(5), F.length(e)), seed)))
        .when(kind == "iban", _iban(e, seed))
        .otherwise(scramble(e, seed))
    )


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), 0)


def may_hold(text: Column) -> Column:
    """Whether the pattern can find anything: every entity has one of a few marks or a form of address."""
    out = text.rlike(MARKS)
    for title in [*MALE, *FEMALE, *NEUTRAL]:
        out = out | text.contains(title)
    return F.coalesce(out, F.lit(False))


def draw_distinct(items: DataFrame, item: str, candidate: Callable[[Column], Column], claims: Callable[[Column], Column], taken: DataFrame, secret: Column, scope: Column) -> DataFrame:
    """items with `new`, drawn by candidate(attempt) until no two items claim the same and none claims what is taken.

    claims: the strings that an item with a `new` claims, as an array. taken: one column.
    candidate finds what replacements follow from in the column SEED: a hash of the key, scope,
    item and attempt.
    Each round draws again only for items that lost; the least item keeps a claim.
    """
    named = persist(items.withColumn("attempt", F.lit(0)), "items")
    while True:
        drawn = persist(named.withColumn(SEED, seed_of(secret, scope, F.col(item), F.col("attempt"))).withColumn("new", candidate(F.col("attempt"))).drop(SEED), "drawn")
        claimed = drawn.select(F.col(item).alias("_item"), F.explode(F.array_distinct(claims(F.col("new")))).alias("claim"))
        first = claimed.groupBy("claim").agg(F.min("_item").alias("first"))
        lost = claimed.join(first, "claim").where("_item <> first").select("_item")
        against = claimed.join(taken.toDF("claim"), "claim", "left_semi").select("_item")
        again = persist(lost.unionByName(against).distinct(), "again")
        if not again.limit(1).count():
            discard(named, again)
            return drawn.drop("attempt")
        redo = F.col("_item").isNotNull().cast("int")
        after = persist(drawn.drop("new").join(again, F.col(item) == F.col("_item"), "left").withColumn("attempt", F.col("attempt") + redo).drop("_item"), "items")
        discard(named, drawn, again)
        named = after


def draw_names(persons: DataFrame, secret: Column) -> DataFrame:
    """entity, kind, surrogate of names with their form of address: each word by itself."""
    e = F.col("entity")
    title, bare = F.regexp_extract(e, NAME, 0), F.regexp_extract(e, r"^\p{L}+", 0)
    gender = F.when(bare.isin(MALE), "m").when(bare.isin(FEMALE), "f").otherwise("n")
    words = F.split(F.substr(e, F.length(title) + 1, F.length(e)), " ")
    listed = persons.select("entity", title.alias("title"), gender.alias("gender"), F.size(words).alias("n"), F.posexplode(words).alias("i", "w"))
    listed = listed.select("entity", "title", "gender", "n", "i", F.posexplode(F.regexp_extract_all("w", F.lit(rf"{_LETTER}+|[^\p{{L}}\p{{M}}]+"), 0)).alias("j", "shown"), "w")
    # of a word's pieces: particles, punctuation and the O of O'Brien stay; an initial becomes another
    stays = ~F.col("shown").rlike(rf"^{_LETTER}") | F.col("w").isin(PARTICLES) | ((F.length("shown") == 1) & F.col("w").rlike("^.['’]") & (F.col("j") == 0))
    kind = F.when(stays, "stays").when(F.length("shown") == 1, "initial").otherwise("name")
    listed = persist(listed.withColumns({"word": F.lower("shown"), "last": F.col("i") == F.col("n") - 1, "piece": kind}).drop("w"), "words")
    atoms = listed.where("piece = 'name'").select("word", "last").distinct().withColumn("atom", F.concat_ws("|", "word", F.col("last").cast("string")))
    drawn = draw_distinct(atoms, "atom", lambda attempt: name_stem(F.col("word"), attempt, F.col(SEED)), lambda new: name_forms(F.col("word"), new, F.col("last")), listed.where("piece = 'name'").select("word").distinct(), secret, F.lit("name"))
    # without a gender a surname follows its own ending, a first name is male
    female = (F.col("gender") == "f") | ((F.col("gender") == "n") & F.col("last") & F.col("word").rlike("[аяηα]$"))
    chosen = F.element_at(name_forms(F.col("word"), F.col("new"), F.col("last")), F.when(female, 2).otherwise(1))
    cased = F.when(F.upper("shown") == F.col("shown"), F.upper(chosen)).otherwise(F.initcap(chosen))
    # an initial is never itself
    letters = F.lit("ABCDEFGHIJKLMNOPRSTVW")
    turned = (_draw(F.col(SEED), F.lit(0)) % 20 + F.call_function("instr", letters, F.col("shown"))) % 21
    initial = F.substr(letters, turned + 1, F.lit(1))
    part = F.when(F.col("piece") == "stays", F.col("shown")).when(F.col("piece") == "initial", initial).otherwise(cased)
    parts = listed.join(drawn.select("word", "last", "new", F.lit("name").alias("piece")), ["word", "last", "piece"], "left").withColumn(SEED, seed_of(secret, F.lit("initial"), F.col("shown"), F.lit(0))).select("entity", "title", "i", "j", part.alias("part"))
    word = parts.groupBy("entity", "title", "i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("j", "part"))), lambda x: x["part"]), "").alias("part"))
    whole = word.groupBy("entity", "title").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), " ").alias("name"))
    return whole.select("entity", F.lit("person").alias("kind"), F.concat("title", "name").alias("surrogate"))


#: The column that replacements are drawn from; it is dropped before anything is written.
SEED = "_silt_seed"


def seed_of(secret: Column, scope: Column, item: Column, attempt: Column) -> Column:
    """Of one length whatever the item's, as it is hashed again for the letters."""
    return F.sha2(F.concat(secret, F.lit("|"), scope, F.lit("|"), item, F.lit("|"), attempt.cast("string")), 256)


def hidden(spark: SparkSession, key: str) -> Column:
    """The key as a scalar subquery over a one-row table: plans name the table and not what it holds."""
    return spark.createDataFrame([(key,)], "secret string").scalar()


def draw_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """entity, kind, surrogate for distinct entities; replacements are distinct and are no entity."""
    secret = hidden(entities.sparkSession, key)
    named = persist(entities.withColumn("kind", kind_of(F.col("entity"))), "entities")
    others = named.where("kind <> 'person'").withColumn("domain", F.when(F.col("kind") == "email", F.lower(F.substring_index("entity", "@", -1))))
    domains = others.where("domain IS NOT NULL").select("domain").distinct()
    new_domains = draw_distinct(domains, "domain", lambda attempt: domain_surrogate(F.col("domain"), attempt, F.col(SEED)), F.array, domains, secret, F.lit("domain")).withColumnRenamed("new", "new_domain")
    joined = others.join(new_domains, "domain", "left")
    drawn = draw_distinct(joined, "entity", lambda attempt: surrogate(F.col("entity"), F.col("kind"), attempt, F.col("new_domain"), F.col(SEED)), F.array, named.select("entity"), secret, F.col("kind"))
    return drawn.select("entity", "kind", F.col("new").alias("surrogate")).unionByName(draw_names(named.where("kind = 'person'"), secret))


def entities_by_text(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """_text_hash and _entities, in order, of each distinct text that holds any."""
    text = F.col(text_col)
    return texts.where(may_hold(text)).select(F.sha2(text, 256).alias("_text_hash"), _found(text).alias("_entities")).where(F.size("_entities") > 0).distinct()


def entity_table(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """entity, kind, surrogate: each distinct entity of the texts with its replacement."""
    return draw_surrogates(entities_by_text(texts, text_col).select(F.explode("_entities").alias("entity")).distinct(), key)


def session_key(spark: SparkSession) -> str:
    """The key in spark.siltstone.pii.key; where that is unset, a random one for this session."""
    name = "spark.siltstone.pii.key"
    if not spark.conf.get(name, None):
        spark.conf.set(name, secrets.token_hex(32))
    return spark.conf.get(name)


def replace_pii(docs: DataFrame, key: str, text_col: str = "text", details: bool = False) -> DataFrame:
    """docs with surrogates in place of entities; with details also _entities, what was found, in order."""
    if not key:
        raise ValueError("a key is needed")
    # rows travel in a struct, so that names of columns cannot clash
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    text = F.col("text")
    found = persist(entities_by_text(docs.select(text_col), text_col), "found")
    table = draw_surrogates(found.select(F.explode("_entities").alias("entity")).distinct(), key)
    mentions = found.select("_text_hash", F.explode(F.array_distinct("_entities")).alias("entity"))
    swaps = mentions.join(table, "entity").groupBy("_text_hash").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_swap"))
    ready = persist(found.join(swaps, "_text_hash").select("_text_hash", "_entities", F.transform("_entities", lambda e: F.element_at(F.col("_swap"), e)).alias("_new")), "ready")
    joined = rows.where(may_hold(text)).withColumn("_text_hash", F.sha2(text, 256)).join(ready, "_text_hash", "left")
    parts = F.split(text, PATTERN, -1)
    whole = F.array_join(F.zip_with(parts, F.array_append("_new", F.lit("")), lambda p, s: F.concat(p, s)), "")
    none = F.array().cast("array<string>")
    replaced = joined.select("row", F.when(F.col("_new").isNotNull(), whole).otherwise(text).alias("text"), F.coalesce("_entities", none).alias("found"))
    out = replaced.unionByName(rows.where(~may_hold(text)).select("row", "text", none.alias("found")))
    columns = [F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns if not (details and c == "_entities")]
    return out.select(*columns, *([F.col("found").alias("_entities")] if details else []))
