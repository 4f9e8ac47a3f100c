"""PII: keyed surrogates for detected entities, with DataFrame functions only.

Every entity gets a replacement of its own kind and format, from a keyed digest of its canonical form, so all its
mentions, however written, change alike. Replacements that two entities would share, or that are themselves somebody's
real value, are drawn again until none collide.

Names and addresses are replaced in two parts, each with a replacement of its own: given and family name, what stands
before the @ and the domain. So a person named in full and by family name alone stays one person, and addresses share a
domain only where they did before. As no family name and no domain is replaced by a real one, no whole name or address is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagewright.llm.common import discard, row_key, stored

#: Given names that replace given names, by gender and script, and family names by script.
GIVEN = {
    ("f", "latin"): "Anna Maria Laura Julia Sofia Clara Elena Marta Paula Nora Emma Alice Lucia Irene Sara Eva".split(),
    ("m", "latin"): "Marco Paul Lukas David Martin Peter Simon Jonas Daniel Victor Oscar Hugo Felix Leon Adam Emil".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Ирина Вера Нина Дарья".split(),
    ("m", "cyrillic"): "Иван Пётр Павел Олег Борис Антон Денис Роман".split(),
}
FAMILY = {
    "latin": "Keller Moreau Rossi Vidal Brandt Fontana Lambert Castro Weber Marin Duval Serra Hoffer Leroy Conti Navarro".split(),
    "cyrillic": "Орлов Белов Котов Зимин Лесков Громов Сомов Волгин".split(),
}
#: Titles that precede a name, by the gender they tell.
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Señora", "Sra", "Signora", "Г-жа"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н"]}

#: Rounds of drawing after which what collides gets longer.
GROWS_AFTER = 4
_LABEL = r"(?:password|passwd|pwd|secret|token|api[_-]?key)"
_WORD = r"\p{Lu}[\p{Ll}]+"
#: Kind and pattern; of two that match at one place the first counts.
PATTERNS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]++\.)+[\p{L}]{2,}+"),
    ("secret", rf"(?<![\p{{L}}\p{{N}}])(?i:{_LABEL})[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?[^\s\"']{{6,}}+"),
    ("key", r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?![\p{L}\p{N}])"),
    ("ip", r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![\p{L}\p{N}]|\.[0-9])"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("card", r"(?<![\p{L}\p{N}+])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{3,4}(?![\p{L}\p{N}])"),
    ("ssn", r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])"),
    ("phone", r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?|\([0-9]{2,4}\)[ .-]?)[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\p{L}\p{N}])"),
    ("name", rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(TITLES['f'] + TITLES['m'])})\.? {_WORD}(?: {_WORD})?(?![\p{{L}}\p{{N}}])"),
]
ANY = "|".join(p for _, p in PATTERNS)
#: A text without any of these signs of an entity isn't searched.
HINT = r"[0-9@]|(?i:password|passwd|pwd|secret|token|key)|" + "|".join(TITLES["f"] + TITLES["m"])


def kind_of(match: Column) -> Column:
    """The kind whose pattern the whole match fits."""
    whens = [F.when(match.rlike(rf"(?s)\A(?:{p})\z"), F.lit(k)) for k, p in PATTERNS]
    return F.coalesce(*whens, F.lit("other"))


def kept_part(kind: Column, match: Column) -> Column:
    """What stays as it is before the entity itself: the label of a secret, the title of a name."""
    secret = F.regexp_extract(match, rf"(?s)\A(?i:{_LABEL})[ ]{{0,2}}[=:][ ]{{0,2}}[\"']?", 0)
    title = F.regexp_extract(match, r"\A[^ ]+ ", 0)
    return F.when(kind == "secret", secret).when(kind == "name", title).otherwise("")


def canonical(kind: Column, own: Column) -> Column:
    """One form for all ways of writing an entity."""
    digits = F.regexp_replace(own, "[^0-9]", "")
    plain = F.regexp_replace(own, "[ -]", "")
    return F.when(kind == "email", F.lower(own)).when(kind.isin("card", "ssn", "phone"), digits).when(kind == "iban", plain).otherwise(own)


def _number(digest: Column, at: int, below: int | Column) -> Column:
    """A number from eight hex digits of the digest."""
    return F.pmod(F.conv(F.substring(digest, at, 8), 16, 10).cast("long"), F.lit(below) if isinstance(below, int) else below).cast("int")


def _stream(digest: Column, length: Column) -> Column:
    """As many keyed numbers below 65,536 as asked, for texts of any length."""
    return F.transform(F.sequence(F.lit(0), F.greatest(length - 1, F.lit(0))), lambda i: F.conv(F.substring(F.sha2(F.concat(digest, i.cast("string")), 256), 1, 4), 16, 10).cast("int"))


def _alike(text: Column, digest: Column) -> Column:
    """A digit for each digit, a letter of the same case and script for each letter; other characters stay.

    Hexadecimal text stays hexadecimal.
    """
    hexadecimal = text.rlike(r"\A[0-9a-f]{8,}\z")
    letters = {"[a-z]": ("abcdefghijklmnopqrstuvwxyz", 26), "[A-Z]": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26), "[0-9]": ("0123456789", 10), "[а-я]": ("абвгдежзийклмнопрстуфхцчшщъыьэюя", 32), "[А-Я]": ("АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", 32), r"\p{Lu}": ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26), r"\p{L}": ("abcdefghijklmnopqrstuvwxyz", 26)}

    def one(c: Column, n: Column) -> Column:
        return F.coalesce(F.when(hexadecimal & c.rlike("[a-f]"), F.substring(F.lit("abcdef"), n % 6 + 1, F.lit(1))), *(F.when(c.rlike(p), F.substring(F.lit(s), n % size + 1, F.lit(1))) for p, (s, size) in letters.items()), c)

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.zip_with(chars, _stream(digest, F.length(text)), one), "")


def _luhn(digits: Column) -> Column:
    """The digits with the last one set so that a card number's check holds."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n - 1),
        F.lit(0),
        lambda acc, i: acc + (lambda d: F.when((n - i) % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d))(F.substring(digits, i, F.lit(1)).cast("int")),
    )
    return F.concat(F.substring(digits, F.lit(1), n - 1), ((10 - total % 10) % 10).cast("string"))


def _iban(plain: Column) -> Column:
    """The account number with its two check digits set so that they hold."""
    country, own = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    values = F.transform(F.filter(F.split(F.concat(own, country, F.lit("00")), ""), lambda c: c != ""), lambda c: F.conv(c, 36, 10).cast("int"))
    rest = F.aggregate(values, F.lit(0), lambda acc, v: (acc * F.when(v < 10, 10).otherwise(100) + v) % 97)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), own)


def _pick(names: list[str], digest: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), _number(digest, at, len(names)) + 1)


def surrogate(kind: Column, canon: Column, gender: Column, attempt: Column, digest: Column) -> Column:
    """The replacement of one part: of an address what stands before the @, its domain as it is; else of the whole."""
    # What still collides grows by a letter in each further round.
    longer = F.greatest(attempt - GROWS_AFTER, F.lit(0))
    grown = _alike(F.repeat(F.lit("z"), longer), F.sha2(digest, 256))
    email = F.concat(_alike(F.substring_index(canon, "@", 1), digest), grown, F.lit("@"), F.substring_index(canon, "@", -1))
    domain = F.concat(_alike(F.regexp_replace(canon, r"\.[^.]*\z", ""), digest), grown, F.lit("."), F.substring_index(canon, ".", -1))
    ip = F.concat_ws(".", *((_number(digest, 1 + 8 * i, 254) + 1).cast("string") for i in range(4)))
    rest = lambda at: _alike(F.substring(canon, F.lit(at), F.length(canon)), digest)
    card, phone = _luhn(F.concat(F.substring(canon, 1, 1), rest(2))), F.concat(F.substring(canon, 1, 1), rest(2))
    iban = _iban(F.concat(F.substring(canon, 1, 2), rest(3)))
    key = F.concat(F.regexp_extract(canon, r"\A(AKIA|gh[pousr]_|sk-|)", 1), _alike(F.regexp_replace(canon, r"\A(AKIA|gh[pousr]_|sk-)", ""), digest))
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    first, second = (F.coalesce(*(F.when((gender == g) & (script == s), _pick(names, digest, at)) for (g, s), names in GIVEN.items())) for at in (1, 17))
    family = F.coalesce(*(F.when(script == s, _pick(names, digest, 9)) for s, names in FAMILY.items()))
    # Lists of names are short; when one has run out there are two given names in one, and families by a last syllable.
    double = F.when(attempt > 0, F.lower(second)).otherwise("")
    tail = F.when(attempt > 0, F.when(script == "cyrillic", _pick("ин ов ский енко".split(), digest, 17)).otherwise(_pick("ini ard sen mann elli ova eau ton".split(), digest, 17))).otherwise("")
    letters = F.concat(F.lit("aaaa"), F.repeat(F.lit("a"), longer))
    more = F.when(attempt > 2, _alike(F.when(script == "cyrillic", F.translate(letters, "a", "а")).otherwise(letters), digest)).otherwise("")
    own = {"email": email, "domain": domain, "ip": ip, "card": card, "iban": iban, "phone": phone, "key": F.concat(key, grown), "given": F.concat(first, double, more), "name": F.concat(family, more, tail), "secret": F.concat(_alike(canon, digest), grown)}
    return F.coalesce(*(F.when(kind == k, fresh) for k, fresh in own.items()), _alike(canon, digest))


def in_format(kind: Column, own: Column, fresh: Column) -> Column:
    """The replacement written as the mention was: its blanks, brackets and dashes, and capitals of an address."""
    chars = F.filter(F.split(own, ""), lambda c: c != "")
    spread = F.aggregate(
        chars,
        F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda acc, c: F.when(c.rlike("[A-Za-z0-9]"), F.struct(F.concat(acc["out"], F.substring(fresh, acc["at"], F.lit(1))).alias("out"), (acc["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["at"].alias("at"))),
        lambda acc: acc["out"],
    )
    upper = F.when((own == F.upper(own)) & (own != F.lower(own)), F.upper(fresh)).otherwise(fresh)
    return F.when(kind.isin("card", "ssn", "phone", "iban"), spread).when(kind == "email", upper).otherwise(fresh)


def surrogates(entities: DataFrame, key: str, rounds: int = 200) -> DataFrame:
    """entities: distinct kind, canon, gender. Adds fresh: replacements distinct within a kind, none of them an entity.

    Given names (kind given, canon the gender and the name) may be those of others but not the own one; an address keeps
    its domain here, which is a part of its own.

    Each round draws anew for those that collide (all but the first by canonical form). Names, addresses, secrets and
    keys get longer with the rounds, so they always find a place; numbers of a fixed format raise an error if they still
    collide after the last round, that is, if there are more of them than the format has room for.
    """
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def drawn(rows: DataFrame, attempt: int) -> DataFrame:
        # Entities are few beside the work that each one is, so they are dealt out first; a draw is used twice.
        dealt = rows.repartition(parts, "kind", "canon").withColumn("attempt", F.lit(attempt))
        digest = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "canon", F.col("attempt").cast("string")), 256)
        fresh = surrogate(F.col("kind"), F.col("canon"), F.col("gender"), F.col("attempt"), digest)
        return stored(dealt.select("kind", "canon", "gender", fresh.alias("fresh")), "draw")

    left, settled = entities, None
    for attempt in range(rounds):
        wanted = drawn(left, attempt)
        real = entities.select("kind", F.col("canon").alias("fresh")).withColumn("real", F.lit(True))
        firsts = wanted.groupBy("kind", "fresh").agg(F.min("canon").alias("first"))
        judged = wanted.join(firsts, ["kind", "fresh"]).join(real, ["kind", "fresh"], "left")
        if settled is not None:
            judged = judged.join(settled.select("kind", "fresh", F.lit(True).alias("taken")), ["kind", "fresh"], "left")
        else:
            judged = judged.withColumn("taken", F.lit(None).cast("boolean"))
        same = (F.col("kind") == "given") & (F.substring_index("canon", " ", -1) == F.col("fresh"))
        fine = F.col("real").isNull() & F.col("taken").isNull() & (F.col("canon") == F.col("first")) & ~same
        step = stored(judged.select("kind", "canon", "gender", "fresh", fine.alias("fine")), "surrogates")
        discard(wanted)
        good, left = step.where("fine").drop("fine"), step.where(~F.col("fine")).select("kind", "canon", "gender")
        settled = good if settled is None else settled.unionByName(good)
        if left.isEmpty():
            return settled
    raise ValueError(f"numbers of a fixed format still collide after {rounds} rounds")


def mentions_of(docs: DataFrame) -> DataFrame:
    """docs' key with each different mention in its text: mention, kind, kept, own, canon, gender.

    The canonical form of a full name begins with its gender, as two persons may share a name; a family name alone doesn't
    tell whose it is.
    """
    hit = docs.where(F.col("text").rlike(HINT)).select("key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(ANY), 0))).alias("mention"))
    kinds = hit.withColumn("kind", kind_of(F.col("mention")))
    parts = kinds.withColumn("kept", kept_part(F.col("kind"), F.col("mention")))
    own = parts.withColumn("own", F.substring(F.col("mention"), F.length("kept") + 1, F.length("mention")))
    female = reduce(lambda a, b: a | b, (F.col("kept").startswith(t) for t in TITLES["f"]))
    gender = F.when(F.col("kind") == "name", F.when(female, "f").otherwise("m")).otherwise("")
    full = (F.col("kind") == "name") & F.col("own").contains(" ")
    canon = F.when(full, F.concat(gender, F.lit(" "), F.col("own"))).otherwise(canonical(F.col("kind"), F.col("own")))
    return own.withColumn("canon", canon).withColumn("gender", gender)


def parts_of(entities: DataFrame) -> DataFrame:
    """The one or two parts of each entity that are replaced on their own: kind, canon, gender, at, part_kind, part."""
    canon, kind = F.col("canon"), F.col("kind")
    part = lambda at, k, c: F.struct(F.lit(at).alias("at"), k.alias("part_kind"), c.alias("part"))
    name = F.array(part(0, F.lit("given"), F.substring_index(canon, " ", 2)), part(1, kind, F.substring_index(canon, " ", -1)))
    email = F.array(part(0, kind, canon), part(1, F.lit("domain"), F.substring_index(canon, "@", -1)))
    whole = F.array(part(0, kind, canon))
    parts = F.when((kind == "name") & canon.contains(" "), name).when(kind == "email", email).otherwise(whole)
    return entities.select("kind", "canon", "gender", F.inline(parts))


def replaced(entities: DataFrame, key: str) -> DataFrame:
    """entities: distinct kind, canon, gender. Their kind, canon and fresh, put together from their parts' replacements."""
    split = stored(parts_of(entities), "parts")
    gender = F.max(F.when(F.col("part_kind").isin("given", "name"), F.col("gender")).otherwise("")).alias("gender")
    fresh = surrogates(stored(split.groupBy(F.col("part_kind").alias("kind"), F.col("part").alias("canon")).agg(gender), "distinct-parts"), key)
    found = split.join(fresh.select(F.col("kind").alias("part_kind"), F.col("canon").alias("part"), "fresh"), ["part_kind", "part"])
    first, second = (F.max(F.when(F.col("at") == i, F.col("fresh"))).alias(n) for i, n in enumerate(["first", "second"]))
    both = found.groupBy("kind", "canon").agg(first, second)
    address = F.concat(F.substring_index("first", "@", 1), F.lit("@"), F.col("second"))
    return both.select("kind", "canon", F.when(F.col("kind") == "email", address).otherwise(F.concat_ws(" ", "first", "second")).alias("fresh"))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with replaced entities in text, and the new column n_replaced (mentions replaced, long).

    Whole texts are searched. Equal entities get equal replacements in all documents, different ones different ones; a
    family name is replaced alike alone and after a given name, a domain alike in all addresses.
    A null text stays null; repeated rows are treated alike. A column of docs named n_replaced is replaced. The same
    key gives the same replacements for the same table.
    """
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").where(F.col("text").isNotNull())
    mentions = stored(mentions_of(keyed), "mentions")
    entities = mentions.groupBy("kind", "canon").agg(F.max("gender").alias("gender"))
    fresh = replaced(stored(entities, "entities"), key)
    written = mentions.join(fresh, ["kind", "canon"])
    pairs = written.select("key", F.struct("mention", F.concat("kept", in_format(F.col("kind"), F.col("own"), F.col("fresh"))).alias("to")).alias("pair"))
    table = pairs.groupBy(F.col("key").alias("__key")).agg(F.map_from_entries(F.array_distinct(F.collect_list("pair"))).alias("__to"))
    columns = [c for c in docs.columns if c != "n_replaced"]
    out = docs.select(*columns, row_key(F.col("doc_id"), F.col("text")).alias("__key")).join(table, "__key", "left")
    found = F.regexp_extract_all("text", F.lit(ANY), 0)
    between = F.split("text", ANY)
    swapped = F.array_join(F.zip_with(between, F.transform(found, lambda m: F.col("__to")[m]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return out.select(
        *(F.when(F.col("__to").isNull(), F.col("text")).otherwise(swapped).alias("text") if c == "text" else F.col(c) for c in columns),
        F.when(F.col("__to").isNull(), F.lit(0)).otherwise(F.size(found)).cast("long").alias("n_replaced"),
    )
