"""Personal data: patterns propose spans, checks confirm them, context adjusts.

Everything is DataFrame functions. Per kind, the matches of a pattern and the
texts between them (one ``regexp_extract_all`` and, where it found something,
one ``split``) give the positions as running sums of lengths. A check confirms
or drops a match (Luhn for card numbers, mod-97 for IBANs, octet range,
digit counts); words shortly before it raise its score. Kinds marked ``base``
stay whatever their score; the others need ``least_score`` and must not
overlap a base span.

The patterns are possessive where the plain form cannot match differently, so
a text costs linear time however long its runs of letters or digits are.

Defined cases: NULL text is the empty text, which has no spans; a failing
match is dropped without another try inside it; repeated rows are each
searched; an empty table gives an empty result; other columns are kept, a
clashing output name gets a numbered suffix.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

CONTEXT_CHARS = 40


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets(m: Column) -> Column:
    """All four parts at most 255, leading zeros allowed."""
    def small(p: Column) -> Column:
        bare = F.regexp_replace(p, "^0+", "")
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(m, r"\."), small)


def _card(m: Column) -> Column:
    d = _digits(m)
    return F.length(d).between(12, 19) & F.call_function("luhn_check", d)


def _phone(m: Column) -> Column:
    return F.length(_digits(m)).between(9, 15)


def _mod97(m: Column) -> Column:
    """First four characters to the end, letters as 10 to 35, remainder 1."""
    bare = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4)))

    def step(r: Column, c: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return F.pmod(F.when(v > 9, r * 100).otherwise(r * 10) + v, F.lit(97))

    return F.aggregate(F.split(moved, "(?!^)(?!$)"), F.lit(0), step) == 1


def _always(m: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    guard: str  # a cheap test that every text with a match passes
    pattern: str
    check: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False


KINDS = (
    Kind("email", "@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _always, 0.8,
         r"mail|contact|write|address", base=True),
    Kind("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _octets, 0.6, r"\bip\b|host|server|address|from",
         base=True),
    Kind("card", "[0-9]", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.7, r"card|visa|master|credit|debit|pay", base=True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, r"phone|tel|call|fax|mobile|cell|contact", base=True),
    Kind("iban", "[A-Z]{2}[0-9]{2}",
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", _mod97, 0.8,
         r"iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", "[0-9]{3}-[0-9]{2}-", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", _always, 0.5,
         r"ssn|social|security"),
    Kind("local_phone", "[0-9]{3}[ .-][0-9]{4}",
         r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])", _always, 0.3,
         r"phone|tel|call|fax|mobile|cell|contact"),
    Kind("access_key", "AKIA", r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])", _always, 0.8, r"key|secret|token"),
)
BASE = [k.name for k in KINDS if k.base]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Prefix sums (or maxima) of an array by doubling: n log n, any length."""
    rounds = F.sequence(F.lit(0), F.floor(F.log2(F.size(values) + 1)).cast("int"))

    def double(acc: Column, k: Column) -> Column:
        step = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= step, join(x, F.get(acc, i - step))).otherwise(x))

    return F.aggregate(rounds, values, double)


def _spans(docs: DataFrame, text: str, found: str, least_score: float) -> DataFrame:
    """``docs`` with an array ``found`` of structs by start, kind and end."""
    kept = docs.columns
    name = {(k.name, part): common.fresh(docs, f"pii_{k.name}_{part}") for k in KINDS for part in ("m", "g", "a", "e", "s")}
    body = F.coalesce(common.col(text), F.lit(""))
    none = F.array().cast("array<string>")
    df = docs.withColumns({name[k.name, "m"]: F.when(body.rlike(k.guard), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0)))
                           .otherwise(none) for k in KINDS})
    df = df.withColumns({name[k.name, "g"]: F.when(F.size(name[k.name, "m"]) > 0, F.split(body, k.pattern, -1)).otherwise(none)
                         for k in KINDS})
    df = df.withColumns({name[k.name, "a"]: F.zip_with(name[k.name, "m"], F.slice(name[k.name, "g"], F.lit(1), F.size(name[k.name, "m"])),
                                                       lambda m, g: F.length(m) + F.length(g)) for k in KINDS})
    df = df.withColumns({name[k.name, "e"]: _running(F.col(name[k.name, "a"]), lambda x, y: x + y) for k in KINDS})

    def span(k: Kind, rank: int) -> Column:
        pairs = F.zip_with(name[k.name, "m"], F.slice(name[k.name, "g"], F.lit(1), F.size(name[k.name, "m"])),
                           lambda m, g: F.struct(m.alias("m"), F.lower(F.right(g, F.lit(CONTEXT_CHARS))).alias("c")))
        made = F.zip_with(pairs, name[k.name, "e"], lambda p, e: F.struct(
            (e - F.length(p["m"])).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), F.lit(k.name).alias("kind"),
            p["m"].alias("value"), F.when(k.check(p["m"]), F.when(p["c"].rlike(k.context), k.score + 0.2).otherwise(k.score))
            .alias("score")))
        return F.filter(made, lambda s: s["score"].isNotNull() if k.base else s["score"] >= least_score)

    df = df.withColumns({name[k.name, "s"]: span(k, i) for i, k in enumerate(KINDS)})
    every, before, after = (common.fresh(docs, f"pii_all_{x}") for x in "xyz")
    df = df.withColumn(every, F.sort_array(F.concat(*[F.col(name[k.name, "s"]) for k in KINDS])))
    n_base = len(BASE)
    far = 2**31 - 1
    df = df.withColumns({
        before: F.transform(every, lambda s: F.when(s["rank"] < n_base, s["end"]).otherwise(0)),
        after: F.reverse(F.transform(every, lambda s: F.when(s["rank"] < n_base, -s["start"]).otherwise(-far)))})
    df = df.withColumns({before: _running(F.col(before), F.greatest), after: F.reverse(_running(F.col(after), F.greatest))})
    clear = F.zip_with(every, F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a"))), lambda s, o: F.struct(
        s.alias("s"), ((s["rank"] < n_base) | ((o["b"] <= s["start"]) & (-o["a"] >= s["end"]))).alias("ok")))
    out = F.transform(F.filter(clear, lambda x: x["ok"]), lambda x: x["s"])
    return df.withColumn(found, out).select(*[common.col(c) for c in kept], F.col(found))


def find(docs: DataFrame, text_col: str = "text", found_as: str = "spans", least_score: float = 0.5) -> DataFrame:
    """``docs`` with an array of (start, rank, end, kind, value, score):
    code points, end exclusive; sorted by start, then kind."""
    return _spans(docs, text_col, common.fresh(docs, found_as), least_score)


def mask(docs: DataFrame, text_col: str = "text", least_score: float = 0.5) -> DataFrame:
    """``docs`` with every found span of the text replaced by its kind, as in
    [EMAIL]; overlapping spans are replaced together under the first kind.
    A text without spans (NULL included) stays as it is."""
    found = common.fresh(docs, "pii_found")
    df = _spans(docs, text_col, found, least_score)
    reach = common.fresh(df, "pii_reach")
    text = common.col(text_col)
    df = df.withColumn(reach, F.transform(found, lambda s: s["end"]))
    df = df.withColumn(reach, _running(F.col(reach), F.greatest))
    # a span begins a masked run if it starts at or after the end of all before it
    steps = F.transform(F.zip_with(found, F.concat(F.array(F.lit(0)), F.slice(reach, F.lit(1), F.greatest(F.size(reach) - 1, F.lit(0)))),
                                   lambda s, r: F.struct(s.alias("s"), r.alias("r"))),
                        lambda x: F.when(x["s"]["start"] >= x["r"], F.concat(
                            F.substr(text, x["r"] + 1, x["s"]["start"] - x["r"]), F.lit("["), F.upper(x["s"]["kind"]), F.lit("]")))
                        .otherwise(""))
    masked = F.concat(F.array_join(steps, ""), F.substr(text, F.element_at(reach, -1) + 1))
    names = [common.col(c) if c != text_col else
             F.when(F.size(found) > 0, masked).otherwise(text).alias(text_col) for c in docs.columns]
    return df.select(*names)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find(common.documents(spark, sf_dir).select("doc_id", "text"), found_as="found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return docs.select("doc_id", *[count(kind) for kind in BASE], F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                       _listed(F.col("found")).alias("spans"), *[count(k.name) for k in KINDS if not k.base])
