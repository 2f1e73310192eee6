"""Personal data replaced by keyed surrogates of the same kind, in DataFrame and SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from msgstream.llm.common import digest, keeps_columns
from msgstream.scratch import stored

KEY = "surrogate-key-of-this-corpus"
# Rounds of drawing again where surrogates collide; what is left then, in crowded formats, gets free values in turn.
ROUNDS = 4

# Titles that stand before names, by gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Signor", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Signora", "Госпожа")
# Syllables that surrogate names are built of, by script, and endings by gender.
LATIN = "ba be bo da de do fa fe ga go ka ke la le lo ma me mo na ne no pa pe ra re ro sa se ta te va vo".split()
CYRILLIC = "ба бе бо да де до га го ка ке ла ле ло ма ме мо на не но па пе ра ре ро са се та те ва ве во за зо".split()
ENDINGS = {"m": ("ndro", "rius", "nard", "lbert"), "f": ("lina", "rella", "nia", "retta")}
CYRILLIC_ENDINGS = {"m": ("слав", "мир", "рий", "нтин"), "f": ("лина", "рия", "ина", "сия")}
FAMILY_ENDINGS, CYRILLIC_FAMILY = ("mann", "son", "ley", "ton"), ("нов", "рин", "ский", "ренко")

_TITLE = "(?:" + "|".join((*MALE, *FEMALE)) + r")\.? "
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
EMAIL = rf"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}@(?:{_LABEL}\.){{1,8}}[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
IP = rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"
PHONE = r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w(+])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w+-])\d{3}-\d{3}-\d{4}(?![\d-])"
CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w]|-\d)"
ACCESS_KEY = r"(?<![A-Z0-9])AKIA[0-9A-Z]{16}(?![A-Z0-9])"
SECRET = (
    r"(?=[A-Za-z0-9+/_-]{12})(?<=(?:password|passwd|secret|token|api_key|apikey) ?[=:] ?[\"']?)(?=[A-Za-z+/_-]{0,127}\d)[A-Za-z0-9+/_-]{12,128}"
)
# What a name looks like is asked first: looking back costs far more.
NAME = rf"(?=\p{{Lu}}\p{{Ll}})(?<= )(?:(?<=(?<!\p{{L}}){_TITLE})|(?<=(?<!\p{{L}}){_TITLE}\p{{Lu}}\p{{Ll}}{{1,30}} ))\p{{Lu}}\p{{Ll}}{{1,30}}"
ENTITY = "|".join((EMAIL, PHONE, CARD, IP, ACCESS_KEY, SECRET, NAME))
# What any entity must hold, cheap to find.
_INITIALS = "".join(sorted({name[0] for name in (*MALE, *FEMALE)}))
HINT = rf"[0-9@]|(?=[{_INITIALS}]){_TITLE}"


def _kind(entity: Column, before: Column, after: Column, joined: Column) -> Column:
    """Kind of an entity, from its shape and, for names, the text between it and its neighbours."""
    male = F.lit(None).cast("string")
    for name in MALE:
        male = F.when(before.rlike(rf"(?<!\p{{L}}){name}\.? $"), "m").otherwise(male)
    gender = F.coalesce(male, F.lit("f"))
    return (
        F.when(entity.contains("@"), "email")
        .when(entity.rlike(rf"\A(?:{_OCTET}\.){{3}}{_OCTET}\z"), "ip")
        .when(entity.rlike(r"\A(?:\+|\(|\d{3}-)"), "phone")
        .when(entity.rlike(r"\A(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})\z"), "card")
        .when(entity.rlike(r"\AAKIA[0-9A-Z]{16}\z"), "key")
        .when(before.rlike(rf"(?<!\p{{L}}){_TITLE}$") & (after == " ") & joined, F.concat(F.lit("given-"), gender))
        .when(entity.rlike(r"\A\p{Lu}\p{Ll}+\z"), "family")
        .when(entity.rlike(r"\A[0-9a-f]+\z"), "hex")
        .otherwise("secret")
    )


def _canonical(kind: Column, entity: Column) -> Column:
    """What is the same in all spellings of one entity: case of addresses and names, marks between digits."""
    digits = F.regexp_replace(entity, r"\D", "")
    return (
        F.when(kind == "phone", F.when(F.length(digits) > 10, F.substring(digits, -10, 10)).otherwise(digits))
        .when(kind == "card", digits)
        .when((kind == "email") | (kind == "family") | kind.startswith("given-"), F.lower(entity))
        .otherwise(entity)
    )


def entities(docs: DataFrame) -> DataFrame:
    """``key, at, kind, canonical, entity`` of each entity of a text; the key is the text's digest."""
    # Both arrays are made once, below an explode; each entity then takes along a few characters of its gaps.
    found = F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)).alias("found")
    cut = F.struct(found, F.split("text", ENTITY, -1).alias("gaps"))
    once = docs.where(F.col("text").rlike(HINT)).select(digest(F.col("text")).alias("key"), F.explode(F.array(cut)).alias("cut"))

    def near_entity(entity: Column, i: Column) -> Column:
        gaps, others = F.col("cut.gaps"), F.col("cut.found")
        return F.struct(
            entity.alias("entity"),
            F.substring(F.get(gaps, i), -40, 40).alias("before"),
            F.substring(F.get(gaps, i + 1), 1, 2).alias("after"),
            F.coalesce(F.get(others, i + 1).rlike(r"\A\p{Lu}\p{Ll}+\z"), F.lit(False)).alias("joined"),
        )

    each = once.select("key", F.posexplode(F.transform("cut.found", near_entity)).alias("at", "near"))
    near = each.select("key", "at", "near.*")
    kinds = near.withColumn("kind", _kind(F.col("entity"), F.col("before"), F.col("after"), F.col("joined")))
    return kinds.select("key", "at", "kind", _canonical(F.col("kind"), F.col("entity")).alias("canonical"), "entity")


# --- surrogates ------------------------------------------------------------------------------------------


def _bytes(seed: Column, i: Column) -> Column:
    """The i-th of 64 keyed byte values, in turn."""
    return F.conv(F.substr(seed, (F.pmod(i, F.lit(64)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _seed(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 512)


def _pick(alphabet: str, value: Column) -> Column:
    return F.substr(F.lit(alphabet), (F.pmod(value, F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))


def _characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _spelled(text: Column, seed: Column) -> Column:
    """Other characters of the same classes: digits, small and capital letters by script; marks stay."""
    classes = (
        ("0123456789", r"\A[0-9]\z"),
        ("abcdefghijklmnopqrstuvwxyz", r"\A[a-z]\z"),
        ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", r"\A[A-Z]\z"),
        ("абвгдежзиклмнопрстуфхцчшэюя", r"\A[а-яё]\z"),
        ("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", r"\A[А-ЯЁ]\z"),
    )

    def other(c: Column, i: Column) -> Column:
        changed = c
        for alphabet, shape in classes:
            changed = F.when(c.rlike(shape), _pick(alphabet, _bytes(seed, i))).otherwise(changed)
        return changed

    return F.array_join(F.transform(_characters(text), other), "")


def _digits(text: Column, seed: Column, least: dict[int, int] | None = None) -> Column:
    """As many other digits; at the given places no digit below the given one."""

    def other(c: Column, i: Column) -> Column:
        value = F.pmod(_bytes(seed, i), F.lit(10))
        for place, low in (least or {}).items():
            value = F.when(i == place, F.pmod(_bytes(seed, i), F.lit(10 - low)) + low).otherwise(value)
        return value.cast("string")

    return F.array_join(F.transform(_characters(text), other), "")


def _luhn(digits: Column) -> Column:
    """Sum of the digits, every second from the right doubled, modulo 10."""
    values = F.transform(F.reverse(_characters(digits)), lambda c: c.cast("int"))
    doubled = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    )
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, d: a + d), F.lit(10))


def _card(digits: Column, seed: Column) -> Column:
    """First digit kept; the last makes the number valid if the original was."""
    body = F.concat(F.substring(digits, 1, 1), _digits(F.substring(digits, 2, 30), seed))
    start = F.substr(body, F.lit(1), F.length(body) - 1)
    check = F.pmod(10 - _luhn(F.concat(start, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn(digits) == 0, F.concat(start, check)).otherwise(body)


def _address(ip: Column, seed: Column) -> Column:
    """Octets of as many digits each."""

    def other(octet: Column, i: Column) -> Column:
        value = _bytes(seed, i * 2) * 256 + _bytes(seed, i * 2 + 1)
        size = F.length(octet)
        return (
            F.when(size == 1, F.pmod(value, F.lit(9)) + 1)
            .when(size == 2, F.pmod(value, F.lit(90)) + 10)
            .otherwise(F.pmod(value, F.lit(154)) + 100)
            .cast("string")
        )

    return F.array_join(F.transform(F.split(ip, r"\."), other), ".")


def _last_label(domain: Column) -> Column:
    return F.concat(F.lit("."), F.substring_index(domain, ".", -1))


def _host(domain: Column) -> Column:
    return F.substr(domain, F.lit(1), F.length(domain) - F.length(_last_label(domain)))


def _domain(domain: Column, key: str, attempt: Column) -> Column:
    """Another domain below the same last label."""
    return F.concat(_spelled(_host(domain), _seed(key, F.lit("domain"), domain, attempt)), _last_label(domain))


def _mail_domain(address: Column, key: str, moved: Column) -> Column:
    """The domain of an address's surrogate: ``moved`` where that is known, or else the first one drawn."""
    return F.coalesce(moved, _domain(F.substring_index(address, "@", -1), key, F.lit(0)))


def _mail(address: Column, seed: Column, key: str, moved: Column) -> Column:
    """Another local part; another domain, the same for all addresses of one domain, below the same last label."""
    return F.concat(_spelled(F.substring_index(address, "@", 1), seed), F.lit("@"), _mail_domain(address, key, moved))


def _name(kind: Column, name: Column, seed: Column) -> Column:
    """A name of syllables in the script of the original, with an ending that fits kind and gender."""
    cyrillic = name.rlike(r"[Ѐ-ӿ]")

    def built(syllables: list[str], endings: tuple[str, ...]) -> Column:
        pool = F.array(*[F.lit(s) for s in syllables])
        parts = [F.get(pool, F.pmod(_bytes(seed, F.lit(i)), F.lit(len(syllables)))) for i in range(3)]
        parts.append(F.get(F.array(*[F.lit(e) for e in endings]), F.pmod(_bytes(seed, F.lit(9)), F.lit(len(endings)))))
        return F.concat(*parts)

    def either(latin: tuple[str, ...], other: tuple[str, ...]) -> Column:
        return F.when(cyrillic, built(CYRILLIC, other)).otherwise(built(LATIN, latin))

    return (
        F.when(kind == "given-m", either(ENDINGS["m"], CYRILLIC_ENDINGS["m"]))
        .when(kind == "given-f", either(ENDINGS["f"], CYRILLIC_ENDINGS["f"]))
        .otherwise(either(FAMILY_ENDINGS, CYRILLIC_FAMILY))
    )


def _surrogate(key: str, kind: Column, canonical: Column, attempt: Column, moved: Column) -> Column:
    seed = _seed(key, kind, canonical, attempt)
    hexadecimal = F.array_join(
        F.transform(_characters(canonical), lambda c, i: _pick("0123456789abcdef", _bytes(seed, i))), ""
    )
    return (
        F.when(kind == "email", _mail(canonical, seed, key, moved))
        .when(kind == "domain", _domain(canonical, key, attempt))
        .when(kind == "ip", _address(canonical, seed))
        .when(kind == "phone", _digits(canonical, seed, {0: 2, 3: 2}))
        .when(kind == "card", _card(canonical, seed))
        .when(kind == "key", F.concat(F.lit("AKIA"), _spelled(F.substring(canonical, 5, 99), seed)))
        .when(kind == "hex", hexadecimal)
        .when(kind == "secret", _spelled(canonical, seed))
        .otherwise(_name(kind, canonical, seed))
    )


# What may stand at one place of a surrogate. Any other code is "=" and the text that stands there.
_WHEELS = {
    "0": "0123456789",
    "2": "23456789",
    "a": "abcdefghijklmnopqrstuvwxyz",
    "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "я": "абвгдежзиклмнопрстуфхцчшэюя",
    "Я": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    "x": "0123456789abcdef",
    "octet1": [str(n) for n in range(1, 10)],
    "octet2": [str(n) for n in range(10, 100)],
    "octet3": [str(n) for n in range(100, 254)],
    "octet": [str(n) for n in range(1, 255)],
    "latin": LATIN,
    "cyrillic": CYRILLIC,
    "latin-m": ENDINGS["m"],
    "latin-f": ENDINGS["f"],
    "latin-family": FAMILY_ENDINGS,
    "cyrillic-m": CYRILLIC_ENDINGS["m"],
    "cyrillic-f": CYRILLIC_ENDINGS["f"],
    "cyrillic-family": CYRILLIC_FAMILY,
}


def _wheel(code: Column) -> Column:
    # Literals only, which Spark turns into one value when it plans.
    wheels = F.create_map(*[x for name, all_of in _WHEELS.items() for x in (F.lit(name), F.split(F.lit(" ".join(all_of)), " "))])
    return F.coalesce(F.try_element_at(wheels, code), F.array(F.substring(code, 2, 1000)))


def _codes(text: Column) -> Column:
    """The classes of :func:`_spelled` by character."""

    def code(c: Column) -> Column:
        found = F.concat(F.lit("="), c)
        for name, shape in (("0", "[0-9]"), ("a", "[a-z]"), ("A", "[A-Z]"), ("я", "[а-яё]"), ("Я", "[А-ЯЁ]")):
            found = F.when(c.rlike(rf"\A{shape}\z"), name).otherwise(found)
        return found

    return F.transform(_characters(text), code)


def _form(key: str, kind: Column, canonical: Column, moved: Column, wide: Column) -> Column:
    """The wheels of an entity's surrogates, place by place, as many values as :func:`_surrogate` can draw; each
    step of ``wide`` makes a longer format: a letter or syllable more, or a digit more in each octet."""

    def literal(text: Column) -> Column:
        return F.array(F.concat(F.lit("="), text))

    def octet(o: Column, i: Column) -> Column:
        size = F.least(F.length(o) + wide, F.lit(3)).cast("string")
        code = F.when(wide > 2, "octet").otherwise(F.concat(F.lit("octet"), size))
        return F.when(i == 0, F.array(code)).otherwise(F.array(F.lit("=."), code))

    more = F.array_repeat(F.lit("a"), wide)
    script = F.when(canonical.rlike(r"[Ѐ-ӿ]"), "cyrillic").otherwise("latin")
    ending = F.concat(script, F.lit("-"), F.regexp_replace(kind, "given-", ""))
    digits = F.transform(_characters(canonical), lambda c, i: F.when(i.isin(0, 3), "2").otherwise("0"))
    zeros = F.array_repeat(F.lit("0"), F.length(canonical) - 2)
    check = F.when(_luhn(canonical) == 0, F.array(F.lit("="))).otherwise(F.array(F.lit("0")))
    return (
        F.when(kind == "email", F.concat(
            _codes(F.substring_index(canonical, "@", 1)), more,
            literal(F.concat(F.lit("@"), _mail_domain(canonical, key, moved)))))
        .when(kind == "domain", F.concat(_codes(_host(canonical)), more, literal(_last_label(canonical))))
        .when(kind == "ip", F.flatten(F.transform(F.split(canonical, r"\."), octet)))
        .when(kind == "phone", digits)
        .when(kind == "card", F.concat(literal(F.substring(canonical, 1, 1)), zeros, check))
        .when(kind == "key", F.concat(F.array(F.lit("=AKIA")), _codes(F.substring(canonical, 5, 99))))
        .when(kind == "hex", F.array_repeat(F.lit("x"), F.length(canonical)))
        .when(kind == "secret", F.concat(_codes(canonical), more))
        .otherwise(F.concat(F.array_repeat(script, wide + 3), F.array(ending)))
    )


def _nth(key: str, kind: Column, form: Column, n: Column) -> Column:
    """The n-th value of a form, each one once: a number whose digits turn the wheels from a keyed place on."""
    seed = _seed(key, kind, F.array_join(form, "\x1e"), F.lit("form"))
    places = F.transform(form, lambda code, i: F.struct(_wheel(code).alias("wheel"), _bytes(seed, i).alias("first")))

    def turned(state: Column, place: Column) -> Column:
        size = F.size(place["wheel"]).cast("long")
        shown = F.get(place["wheel"], F.pmod(F.pmod(state["rest"], size) + place["first"], size).cast("int"))
        return F.struct(
            F.call_function("div", state["rest"], size).alias("rest"), F.concat(state["text"], shown).alias("text")
        )

    start = F.struct(n.cast("long").alias("rest"), F.lit("").alias("text"))
    text = F.aggregate(places, start, turned)["text"]
    check = F.pmod(10 - _luhn(F.concat(text, F.lit("0"))), F.lit(10)).cast("string")
    return F.when((kind == "card") & (F.element_at(form, -1) == "="), F.concat(text, check)).otherwise(text)


def _dealt(lost: DataFrame, used: DataFrame, key: str) -> list[DataFrame]:
    """``kind, canonical, surrogate`` in parts: what lost its draws gets values that are not in ``used``.

    Those of one form, in keyed order, get the form's free values in turn. Values are listed a stretch at a time,
    each as long as all before it, so about as many are made as are used or needed. Where a form has no free
    value left, the next longer one is used; kinds that have none are an error.
    """
    parts: list[DataFrame] = []
    left = lost.select("kind", "canonical", "domain", F.lit(0).alias("wide"), F.lit(0).cast("long").alias("start"))
    while True:
        form = _form(key, F.col("kind"), F.col("canonical"), F.col("domain"), F.col("wide"))
        left = stored(left.withColumn("form", form), "surrogates-lost")
        if left.isEmpty():
            return parts
        sizes = F.transform("form", lambda code: F.size(_wheel(code)).cast("double"))
        room = F.least(F.aggregate(sizes, F.lit(1.0), lambda a, n: a * n), F.lit(1e17)).cast("long")
        classes = left.groupBy("kind", "form").agg(F.count("*").alias("n"), F.min("start").alias("start"))
        classes = classes.withColumn("room", room).withColumn(
            "end", F.least("room", F.col("start") + F.greatest(F.lit(16), F.col("n") * 2, F.col("start")))
        )
        classes = stored(classes, "surrogates-forms")
        listed = classes.select("kind", "form", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("n"))
        listed = listed.withColumn("surrogate", _nth(key, F.col("kind"), F.col("form"), F.col("n")))
        single = listed.groupBy("kind", "surrogate").agg(F.min(F.struct("form", "n")).alias("one"))
        free = single.join(used, ["kind", "surrogate"], "left_anti").select("kind", "surrogate", "one.*")
        by_form = Window.partitionBy("kind", "form")
        free = free.withColumn("rank", F.row_number().over(by_form.orderBy("n"))).drop("n")
        order = _seed(key, F.col("kind"), F.col("canonical"), F.lit("rank"))
        waiting = left.withColumn("rank", F.row_number().over(by_form.orderBy(order, "canonical")))
        turn = stored(waiting.join(free, ["kind", "form", "rank"], "left"), "surrogates-dealt")
        parts.append(turn.where("surrogate IS NOT NULL").select("kind", "canonical", "surrogate"))
        used = used.unionByName(parts[-1].select("kind", "surrogate"))
        rest = turn.where("surrogate IS NULL").select("kind", "canonical", "domain", "wide", "form")
        rest = rest.join(classes.select("kind", "form", "end", (F.col("end") >= F.col("room")).alias("full")), ["kind", "form"])
        fixed = F.col("kind").isin("phone", "card", "key", "hex") | ((F.col("kind") == "ip") & (F.col("wide") > 2))
        stuck = rest.where(F.col("full") & fixed).select("kind").first()
        if stuck is not None:
            raise ValueError(f"surrogates still collide: a format of kind {stuck.kind} has no free value left")
        left = rest.select(
            "kind", "canonical", "domain", (F.col("wide") + F.col("full").cast("int")).alias("wide"),
            F.when(F.col("full"), 0).otherwise(F.col("end")).cast("long").alias("start"),
        )


def _distinct(known: DataFrame, key: str, rounds: int) -> DataFrame:
    """``kind, canonical, surrogate`` of ``kind, canonical, domain``: see :func:`surrogates`."""
    originals = known.select("kind", F.col("canonical").alias("surrogate")).withColumn("taken", F.lit(True))
    drawn = known.select("kind", "canonical", "domain", F.lit(0).alias("attempt"))
    one, order = _surrogate(key, F.col("kind"), F.col("canonical"), F.col("attempt"), F.col("domain")), F.struct("attempt", "canonical")
    for _ in range(rounds):
        named = stored(drawn.withColumn("surrogate", one), "surrogates")
        winners = named.groupBy("kind", "surrogate").agg(F.min(order).alias("first"), F.count("*").alias("n"))
        clashing = winners.join(originals, ["kind", "surrogate"], "left").where("n > 1 OR taken")
        clashing = clashing.select("kind", "surrogate", "first", F.coalesce("taken", F.lit(False)).alias("taken"))
        again = named.join(clashing, ["kind", "surrogate"], "left").withColumn(
            "lost", F.col("first").isNotNull() & (F.col("taken") | (F.col("canonical") != F.col("first.canonical")))
        )
        if again.where("lost").isEmpty():
            return named.select("kind", "canonical", "surrogate")
        drawn = stored(
            again.select("kind", "canonical", "domain", "surrogate", "lost", (F.col("attempt") + F.col("lost").cast("int")).alias("attempt")),
            "draws",
        )
    settled = drawn.where("NOT lost").select("kind", "canonical", "surrogate")
    used = originals.select("kind", "surrogate").unionByName(settled.select("kind", "surrogate"))
    for part in _dealt(drawn.where("lost"), used, key):
        settled = settled.unionByName(part)
    return settled


def surrogates(known: DataFrame, key: str = KEY, rounds: int = ROUNDS) -> DataFrame:
    """``kind, canonical, surrogate``: no two of a kind share one, and none is an entity of the corpus.

    All draw by the key and their own value. Where several have drawn the same, the first of them keeps it
    and the others draw again, as do those that drew an entity that exists. The groups are found by aggregates.
    What has lost ``rounds`` times stands in a crowded format and gets one of its free values, or one of a longer
    format where none is free (:func:`_dealt`). Domains of addresses are told apart in the same way first.
    """
    nothing = F.lit(None).cast("string").alias("domain")
    mail_domain = F.substring_index("canonical", "@", -1)
    domains = known.where("kind = 'email'").select(F.lit("domain").alias("kind"), mail_domain.alias("canonical"), nothing)
    domains = stored(domains.distinct(), "surrogates-domains")
    if domains.isEmpty():
        return _distinct(known.select("kind", "canonical", nothing), key, rounds)
    found = _distinct(domains, key, rounds)
    # Few have not kept what they drew first; only those are sent to their addresses.
    moved = found.where(F.col("surrogate") != _domain(F.col("canonical"), key, F.lit(0)))
    moved = stored(moved.select(F.col("canonical").alias("_of"), F.col("surrogate").alias("domain")), "surrogates-moved")
    if moved.isEmpty():
        return _distinct(known.select("kind", "canonical", nothing), key, rounds)
    mine = F.when(F.col("kind") == "email", mail_domain)
    joined = known.select("kind", "canonical").join(moved, mine == F.col("_of"), "left")
    return _distinct(stored(joined.select("kind", "canonical", "domain"), "surrogates-known"), key, rounds)


def _shown(kind: Column, entity: Column, surrogate: Column) -> Column:
    """The surrogate in the spelling of the entity: marks between digits, capitals."""
    count = F.length(surrogate)
    digits_before = lambda cs, i: F.size(F.filter(F.slice(cs, F.lit(1), i), lambda c: c.rlike(r"\A\d\z")))
    cs = _characters(entity)
    total = F.size(F.filter(cs, lambda c: c.rlike(r"\A\d\z")))
    # Digits before the last `count` are a country code and stay.
    filled = F.array_join(
        F.transform(
            cs,
            lambda c, i: F.when(
                c.rlike(r"\A\d\z") & (digits_before(cs, i) >= total - count),
                F.substr(surrogate, (digits_before(cs, i) - (total - count) + 1).cast("int"), F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    capital = (F.upper(entity) == entity) & (F.lower(entity) != entity)
    return (
        F.when(kind.isin("phone", "card"), filled)
        .when((kind == "family") | kind.startswith("given-"), F.initcap(surrogate))
        .when((kind == "email") & capital, F.upper(surrogate))
        .otherwise(surrogate)
    )


@keeps_columns("text", made="entities")
def replaced(docs: DataFrame, key: str = KEY) -> DataFrame:
    """All rows and columns of ``docs``, personal data in ``text`` replaced, with ``entities``, their number.

    Addresses, phone and card numbers, network addresses, access keys, secrets that follow their name, and
    names after a title get surrogates of their kind: format, length, script, gender, validity of a card
    number, the last label of a domain and the country code of a phone stay. One entity has one surrogate
    wherever it stands and however it is written, and different entities have different ones
    (:func:`surrogates`). Without the key, the surrogate says nothing of the entity.

    Entities alone are shuffled, by value and then by text; texts that hold none are not moved at all, and
    equal texts share one entry, so a text or an entity on a third of all rows is a row a task. NULL text
    stays NULL; NULL ids do not matter; repeated rows are replaced alike; an ``entities`` column of the
    documents' own gives way. No rows give none. Texts of any length are searched whole.
    """
    columns = [c for c in docs.columns if c != "entities"]
    docs = docs.select(*[F.col(f"`{c}`") for c in columns])
    each = stored(entities(docs.select("text")).distinct(), "entities")
    known = stored(each.select("kind", "canonical").distinct(), "entities-known")
    drawn = surrogates(known, key)
    shown = each.join(drawn, ["kind", "canonical"]).withColumn(
        "shown", _shown(F.col("kind"), F.col("entity"), F.col("surrogate"))
    )
    by_text = shown.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "shown"))).alias("_shown"))
    by_text = by_text.withColumnRenamed("key", "_known")
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    joined = docs.where(hinted).withColumn("_key", digest(F.col("text"))).join(by_text, F.col("_key") == F.col("_known"), "left")
    gaps = F.split("text", ENTITY, -1)
    pieces = F.transform(gaps, lambda gap, i: F.concat(gap, F.coalesce(F.get(F.col("_shown"), i)["shown"], F.lit(""))))
    count = F.when(F.col("_shown").isNull(), 0).otherwise(F.size("_shown"))
    changed = joined.withColumn("entities", count.cast("long"))
    changed = changed.withColumn("text", F.when(F.col("_shown").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("text")))
    plain = docs.where(~hinted).withColumn("entities", F.lit(0).cast("long"))
    names = [*[F.col(f"`{c}`") for c in columns], F.col("entities")]
    return changed.select(*names).unionByName(plain.select(*names))
