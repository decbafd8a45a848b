"""Personal data: candidate spans, boosted trees, calibrated thresholds; built-in functions only.

Strict generators give the four base kinds. Loose ones propose overlapping spans that look like an
address, a number or a host: too many, so that little is missed. No row says which of them are personal, so
trees boosted on format and context learn from snippets: values that the strict kinds confirm, written in other ways
at their own places, against versions, dates, prices and the like, there and at other places. A candidate is
added if its score passes its family's threshold, at which right ones prevail among snippets that were not fitted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.boosting import Boosted, fit_boosted
from estatelens.llm.spans import joined, listed, matches, of_kind, placed, replaced, without_overlap
from estatelens.llm.words import packed, unpacked

#: The kinds of the contract, in the order they are listed in. They match as there; what
#: cannot give back characters is possessive, and no match starts inside a run that has failed.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")
BASE_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}

_AT = r"(?:\s?(?:@|[(\[](?i:at)[)\]])\s?|\s(?i:at)\s)"
_DOT = r"(?:\.|\s?[(\[](?i:dot)[)\]]\s?|\s(?i:dot)\s)"
_HOST_DOT = r"\s?(?:\.|[(\[](?:\.|(?i:dot))[)\]])\s?"

#: Loose generators by family; a span of theirs is of the kind ``pii``.
LOOSE_PATTERNS = {
    "address": (rf"[^\s@,;:<>()\[\]]{{1,64}}+{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}})++",),
    "number": (
        r"[+(]?[0-9][0-9().\x20/:-]{5,40}[0-9]",
        r"(?<![0-9])[+(]?[0-9]{2,5}\)?[.\x20/-]{1,2}[0-9]{2,4}[.\x20/-][0-9]{3,4}(?![0-9])",
        r"(?<![0-9])[0-9]{4}(?:[.\x20/-]{1,2}[0-9]{4}){3}(?![0-9])",
    ),
    "host": (rf"(?<![0-9.])[0-9]{{1,3}}(?:{_HOST_DOT}[0-9]{{1,3}}){{3}}(?![0-9.])",),
}
FAMILIES = tuple(LOOSE_PATTERNS)
FURTHER_KIND = "pii"
FOUND = "struct<start:int,end:int,family:int,touches:boolean,features:array<int>>"

#: Confirmed values, and other places, whose snippets are fitted: at most this many of each kind, by hash.
SAMPLE_SEEDS = 400

#: Of the candidates that pass a threshold, this share is right; no threshold is lower than the other.
PRECISION = 0.98
LEAST_SCORE = 0.5

#: Code points of context on either side of a candidate, and of a snippet's value.
CONTEXT = 16
SNIPPET = 32

ROUNDS = 32
DEPTH = 3

FEATURES = (
    "family",
    "length",
    "digits",
    "groups",
    "dots",
    "dashes",
    "blanks",
    "slashes",
    "colons",
    "brackets",
    "letters",
    "last_letters",
    "at",
    "plus",
    "longest_group",
    "shortest_group",
    "last_group",
    "year",
    "check_digit",
    "cue_before",
    "digit_before",
    "digit_after",
    "letter_before",
    "letter_after",
)
_CUES = r"(?i)(mail|phone|tel|mobile|fax|card|visa|account|iban|ssn|address|contact|call|ip)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    each = F.split(F.reverse(digits), "")

    def add(total: Column, x: Column) -> Column:
        d = x["d"].cast("int")
        twice = F.when(2 * d > 9, 2 * d - 9).otherwise(2 * d)
        return total + F.when(x["i"] % 2 == 1, twice).otherwise(d)

    numbered = F.transform(F.filter(each, lambda d: d != ""), lambda d, i: F.struct(d.alias("d"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), add) % 10 == 0


def _card(value: Column) -> Column:
    """Whether the digits are a card's; no near miss is one by chance."""
    digits = _digits(value)
    return F.char_length(digits).between(14, 19) & _luhn(digits)


def _confirmed(kind: str, spans: Column) -> Column:
    """The spans that pass their kind's check."""
    if kind == "ip":

        def small(part: Column) -> Column:
            return F.coalesce(part.try_cast("int") <= 255, F.lit(False))

        return F.filter(spans, lambda s: F.forall(F.split(s["value"], r"\."), small))
    if kind == "card":

        return F.filter(spans, lambda s: _card(s["value"]))
    if kind == "phone":
        return F.filter(spans, lambda s: F.char_length(_digits(s["value"])).between(10, 15))
    return spans


def _described(text: Column, spans: Column, base: Column) -> Column:
    """Each candidate with its features, and whether it touches a base span."""

    def describe(s: Column) -> Column:
        value = s["value"]
        before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        after = F.substring(text, s["end"] + 1, F.lit(3))
        digits = _digits(value)
        groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
        sizes = F.transform(groups, F.char_length)

        def count(pattern: str) -> Column:
            return F.char_length(value) - F.char_length(F.regexp_replace(value, pattern, ""))

        features = (
            s["family"],
            F.char_length(value),
            F.char_length(digits),
            F.size(groups),
            count(r"\."),
            count("-"),
            count(r"\s"),
            count("/"),
            count(":"),
            count(r"[()\[\]]"),
            count(r"[A-Za-z]"),
            F.char_length(F.regexp_extract(value, "[A-Za-z]*$", 0)),
            count("@"),
            value.startswith("+"),
            F.array_max(sizes),
            F.array_min(sizes),
            F.try_element_at(sizes, F.lit(-1)),
            value.rlike(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])"),
            _card(value),
            before.rlike(_CUES),
            before.rlike(r"[0-9][().\x20/:-]{0,2}$"),
            after.rlike(r"^[().\x20/:-]{0,2}[0-9]"),
            before.rlike("[A-Za-z]$"),
            after.rlike("^[A-Za-z]"),
        )
        touches = F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        numbers = F.array(*[F.coalesce(x.cast("int"), F.lit(0)) for x in features])
        return F.struct(s["start"], s["end"], s["family"], touches, numbers).cast(FOUND)

    return F.transform(spans, describe)


def _of_family(spans: Column, family: int) -> Column:
    each = F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["value"], F.lit(family)))
    return each.cast("array<struct<start:int,end:int,value:string,family:int>>")


def _proposed(rows: DataFrame, text: Column) -> tuple[DataFrame, Column]:
    """``rows`` with a column of matches for each loose generator, and the array of their spans with the family.

    Text goes through such stages by reference; only the arrays are new.
    """
    lower = F.lower(text)
    needs = {
        "address": text.contains("@") | (lower.contains("at") & lower.contains("dot")) | lower.rlike(r"[(\[]at[)\]]"),
        "host": text.contains("[") | text.contains("("),
    }
    none, spans = F.array().cast("array<string>"), []
    for i, (family, patterns) in enumerate(LOOSE_PATTERNS.items()):
        for j, pattern in enumerate(patterns):
            name, found = f"pii_{family}_{j}__", matches(text, pattern)
            rows = rows.withColumn(name, F.when(needs[family], found).otherwise(none) if family in needs else found)
            spans.append(_of_family(placed(text, F.col(name), pattern), i))
    return rows, F.array_distinct(F.concat(*spans))


def with_candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with three arrays.

    ``pii_base__`` are the strict spans (``start, rank, end, kind``), ``pii_found__`` the described candidates, and
    ``pii_seeds__`` the confirmed values with what is around them (``kind, before, value, after``), with one more place
    of the text, by hash, as kind ``none``.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text = F.coalesce("text", F.lit(""))
    needs = {"email": text.contains("@"), "phone": text.contains("+")}
    none = F.array().cast("array<string>")
    rows = docs
    for kind, pattern in BASE_PATTERNS.items():
        found = matches(text, pattern)
        rows = rows.withColumn(f"pii_{kind}__", F.when(needs[kind], found).otherwise(none) if kind in needs else found)
    for kind, pattern in BASE_PATTERNS.items():
        rows = rows.withColumn(f"pii_{kind}__", _confirmed(kind, placed(text, F.col(f"pii_{kind}__"), pattern)))
    rows, loose = _proposed(rows, text)

    def seed(kind: str, start: Column, end: Column, value: Column) -> Column:
        begin = F.greatest(start - SNIPPET, F.lit(0))
        return F.struct(
            F.lit(kind).alias("kind"),
            F.substring(text, begin + 1, start - begin).alias("before"),
            value.alias("value"),
            F.substring(text, end + 1, F.lit(SNIPPET)).alias("after"),
        )

    def seeds(kind: str) -> Column:
        return F.transform(F.col(f"pii_{kind}__"), lambda s: seed(kind, s["start"], s["end"], s["value"]))

    place = F.pmod(F.xxhash64("doc_id", F.char_length(text)), F.char_length(text) + 1).cast("int")
    rows = rows.select(
        *columns,
        listed(*[of_kind(F.col(f"pii_{k}__"), k, i) for i, k in enumerate(BASE_KINDS)]).alias("pii_base__"),
        loose.alias("pii_loose__"),
        F.concat(*map(seeds, BASE_KINDS), F.array(seed("none", place, place, F.lit("")))).alias("pii_seeds__"),
    )
    found = _described(text, F.col("pii_loose__"), F.col("pii_base__"))
    return rows.select(*columns, "pii_base__", found.alias("pii_found__"), "pii_seeds__")


_TOPS = ("org", "net", "de", "io", "info")


def _rewritten() -> dict[str, list[Column]]:
    """Other ways to write a confirmed ``value``, by its kind; the strict kinds find none of them whole."""
    value, digits = F.col("value"), _digits(F.col("value"))
    local, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    # Addresses of one corpus may be all of one make, so each is also written plainly, in other domains.
    letters = F.regexp_replace(local, "[^A-Za-z]", "")
    plain = F.when(letters == "", local).otherwise(letters)
    site = F.regexp_replace(F.substring_index(host, ".", 1), "[0-9-]", "")
    site = F.when(site == "", "site").otherwise(site)
    signs = ((" (at) ", " (dot) "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" [at] ", " [dot] "), (" (at) ", "."))
    signs += ((" at ", " dot "), (" AT ", " DOT "), (" @ ", "."), ("[at]", "."))
    bare = F.substring(value, 2, 100)
    ten = F.right(digits, F.lit(10))
    shapes = ("($1) $2-$3", "($1)$2-$3", "$1-$2-$3", "$1.$2.$3", "$1 $2 $3", "$1/$2-$3", "$1 $2-$3")
    return {
        "email": [F.concat(local, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in signs]
        + [F.concat(plain, F.lit(at), site, F.lit(f"{dot}{top}")) for (at, dot), top in zip(signs, _TOPS * 2)]
        + [F.concat(F.left(plain, F.lit(5)), F.lit(f"{at}a-"), site, F.lit(f"{dot}{top}")) for (at, dot), top in zip(signs, _TOPS[::-1] * 2)]
        + [F.concat(local, F.lit(at), F.left(site, F.lit(4)), F.lit(f"{dot}{top}")) for (at, dot), top in zip(signs, _TOPS[2:] * 3)],
        "ip": [F.replace(value, F.lit("."), F.lit(dot)) for dot in ("[.]", "(.)", "[dot]", "(dot)", " [dot] ", " [.] ")]
        + [F.regexp_replace(value, r"\.([0-9]+)$", "[.]$1")],
        "card": [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{mark}") for mark in (".", "/", "  ", "--")],
        "phone": [F.regexp_replace(ten, "^([0-9]{3})([0-9]{3})([0-9]{4})$", shape) for shape in shapes]
        + [bare, F.translate(bare, " -", ".."), F.translate(bare, " ", "-")],
    }


def _near_misses() -> list[Column]:
    """What looks like personal data and is none, from the digits and words of a hash of the seed."""
    sign = F.md5(F.concat_ws("|", "kind", "before", "value", "after").cast("binary"))
    digits = F.translate(sign, "abcdef", "012345")

    def d(place: int, size: int) -> Column:
        return F.substring(digits, place, size)

    def one(place: int, *of: str) -> Column:
        return F.get(F.array(*map(F.lit, of)), F.pmod(F.ascii(F.substring(sign, place, 1)), F.lit(len(of))).cast("int"))

    century, month, hour = one(1, "19", "20"), one(2, "01", "04", "07", "10", "12"), one(3, "08", "10", "13", "19", "23")
    day, dot = one(4, "02", "11", "18", "25", "30"), F.lit(".")
    words = ("look", "stay", "page", "home", "gate", "matrix", "product", "corner", "noon")
    forms = [
        (d(1, 2), ".", d(3, 1), ".", d(4, 3)),
        (d(1, 1), ".", d(2, 2), ".", d(4, 3), ".", d(7, 4)),
        (d(1, 3), "2.", d(4, 2), ".", d(6, 3), ".", d(9, 2)),
        (century, d(1, 2), "-", month, "-", day),
        (day, "/", month, "/", century, d(1, 2)),
        (day, ".", month, ".", century, d(1, 2)),
        (century, d(1, 2), "-", month, "-", day, " ", hour, ":", day, ":", month),
        (hour, ":", day, "-", hour, ":", month),
        (d(1, 4), dot, d(5, 2)),
        (d(1, 3), ".", d(4, 3), ".", d(7, 3)),
        (d(1, 2), " ", d(3, 3), " ", d(6, 3)),
        (d(1, 4), "-", d(5, 4)),
        (century, d(1, 2), "-", century, d(3, 2)),
        ("978-", d(1, 1), "-", d(2, 2), "-", d(4, 6), "-", d(10, 1)),
        (d(1, 8),),
        (d(1, 10),),
        (d(1, 13),),
        ("0.", d(1, 9)),
        ("10.", d(1, 4), "/", century, d(5, 2), ".", month, ".", d(7, 3)),
        (d(1, 3), "-", d(4, 4)),
        (d(1, 4), ".", d(5, 4), ".", d(9, 4), ".", d(13, 4)),
        (F.substring(sign, 1, 24),),
        (one(5, *words), " at ", one(6, *words), " dot ", one(7, *words)),
        (d(1, 2), " @ ", d(3, 1), ".", d(4, 2)),
        (one(8, *words), " @", one(9, *words), ".", one(10, *words)),
    ]
    return [F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in form]) for form in forms]


def training_candidates(rows: DataFrame, sample: int = SAMPLE_SEEDS) -> DataFrame:
    """``fitted, family, features, right, inside`` of the candidates in snippets around at most ``sample`` seeds of each kind.

    A snippet is what stands around a seed with another value between. The candidates are those of the same generators
    that overlap this value; right is one that is just a rewritten value, not a part of it. Inside are those that do not
    reach beyond the value: of the others it is not known what the rest is.
    """
    each = rows.select(F.explode("pii_seeds__").alias("s")).select("s.*")
    draw = F.xxhash64("kind", "before", "value", "after")
    first = Window.partitionBy("kind").orderBy("draw", "before", "value", "after")
    seeds = each.withColumn("draw", draw).withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample)

    def marked(values: list[Column], right: bool) -> Column:
        return F.array(*[F.struct(v.alias("written"), F.lit(right).alias("goal")) for v in values])

    ways = F.array().cast("array<struct<written:string,goal:boolean>>")
    for kind, values in _rewritten().items():
        ways = F.when(F.col("kind") == kind, marked(values, True)).otherwise(ways)
    blank = F.when(F.col("kind") == "none", " ").otherwise("")
    snippets = seeds.select(
        (F.pmod("draw", F.lit(2)) == 0).alias("fitted"),
        F.concat("before", blank).alias("before"),
        F.concat(blank, "after").alias("after"),
        F.explode(F.concat(ways, F.filter(marked(_near_misses(), False), lambda w: ~_card(w["written"])))).alias("way"),
    ).select(
        "fitted",
        "way.goal",
        F.char_length("before").alias("begin"),
        (F.char_length("before") + F.char_length("way.written")).alias("until"),
        F.concat("before", "way.written", "after").alias("snippet"),
    )
    kept = ["fitted", "goal", "begin", "until", "snippet"]
    found, loose = _proposed(snippets, F.col("snippet"))
    found = found.select(*kept, loose.alias("loose"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    found = found.select(*kept, F.explode(_described(F.col("snippet"), F.col("loose"), none)).alias("c"))
    found = found.where((F.col("c.start") < F.col("until")) & (F.col("begin") < F.col("c.end")))
    whole = (F.col("c.start") == F.col("begin")) & (F.col("c.end") == F.col("until"))
    inside = (F.col("c.start") >= F.col("begin")) & (F.col("c.end") <= F.col("until"))
    return found.select("fitted", "c.family", "c.features", (F.col("goal") & whole).alias("right"), inside.alias("inside"))


def fit_selector(rows: DataFrame, sample: int = SAMPLE_SEEDS, precision: float = PRECISION) -> tuple[Boosted, list[float]]:
    """Trees, and a threshold for each family, from the seeds of ``rows``.

    Half of the seeds, by hash, are fitted. A family's threshold is the lowest at which, of the other half's candidates
    inside their value, the share of right ones is ``precision``, and ``LEAST_SCORE`` at least; if there is none, nothing of the family passes.
    """
    taken = training_candidates(rows, sample).collect()
    taken = sorted((r["fitted"], r["family"], r["right"], r["inside"], *r["features"]) for r in taken)
    table = np.array(taken, np.float64).reshape(len(taken), 4 + len(FEATURES))
    fitted, family, right, inside, x = table[:, 0] == 1, table[:, 1], table[:, 2], table[:, 3] == 1, table[:, 4:]
    model = fit_boosted(x[fitted], right[fitted], ROUNDS, DEPTH)
    scores, thresholds = model.scores(x), []
    for i in range(len(FAMILIES)):
        held = ~fitted & inside & (family == i)
        order = np.argsort(-scores[held], kind="stable")
        ranked, good = scores[held][order], right[held][order]
        share = np.cumsum(good) / np.arange(1, len(good) + 1)
        # Equal scores pass together: a cut is only where the next score is lower.
        ends = np.append(ranked[1:] < ranked[:-1], True)[: len(ranked)]
        passing = ranked[ends & (share >= precision)]
        thresholds.append(max(float(passing[-1]), LEAST_SCORE) if len(passing) else 2.0)
    return model, thresholds


def _selected(model: Boosted, thresholds: list[float]) -> Column:
    """Candidates that pass and touch no base span; those that overlap are one span."""
    cuts = F.array(*map(F.lit, thresholds))

    def passes(c: Column) -> Column:
        features = [F.get(c["features"], F.lit(i)) for i in range(len(FEATURES))]
        return ~c["touches"] & (model.column(features) >= F.get(cuts, c["family"]))

    chosen = without_overlap(listed(of_kind(F.filter("pii_found__", passes), FURTHER_KIND, len(BASE_KINDS))))
    return of_kind(chosen, FURTHER_KIND, len(BASE_KINDS))


def find_personal(docs: DataFrame, sample: int = SAMPLE_SEEDS, precision: float = PRECISION) -> DataFrame:
    """``doc_id, base, spans`` of each row; both arrays of ``start, rank, end, kind``, in this order.

    ``base`` are the strict kinds, ``spans`` these and the selected candidates. Places count code points
    from 0. A null or empty text has no spans; equal rows give equal rows; null ids are ids like any other;
    other columns are not read. A family of candidates none of whose kinds is confirmed anywhere adds nothing.
    """
    rows = with_candidates(docs.select("doc_id", "text")).drop("text").checkpoint()
    model, thresholds = fit_selector(rows, sample, precision)
    return rows.select(
        "doc_id", F.col("pii_base__").alias("base"), listed(F.col("pii_base__"), _selected(model, thresholds)).alias("spans")
    )


def redact_personal(docs: DataFrame, sample: int = SAMPLE_SEEDS, precision: float = PRECISION) -> DataFrame:
    """``docs`` with each span replaced by its kind in square brackets; rows without spans stay as they are.

    The columns are those of ``docs``, whatever their names and types. Candidates are found once: rows are kept
    with them, in the shared folder, while the trees are fitted.
    """
    rows = with_candidates(packed(docs)).checkpoint()
    model, thresholds = fit_selector(rows, sample, precision)
    rows = rows.withColumn("pii_spans__", listed(F.col("pii_base__"), _selected(model, thresholds)))
    rows = rows.withColumn("pii_runs__", without_overlap(F.col("pii_spans__")))
    text = replaced(F.col("text"), F.col("pii_runs__"))
    return rows.select(*unpacked(docs, text))


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)
