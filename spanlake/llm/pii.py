"""Personal data by weak supervision, in built-in functions only.

Base spans follow fixed patterns.  Beyond them, looser candidates are voted on by labelers (strict pattern,
checksum, gazetteer, context words, boundaries); each votes yes, no or abstains.  Expectation-maximisation
over the counts of vote patterns, taken over all documents, estimates every labeler's reliability for each
class and the posterior of each pattern; a logistic span classifier is then trained on features of the
spans with those posteriors as targets, and decides which candidates become spans.  Only the table of
pattern counts, whose size is fixed by the labelers, reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Kinds in the order of the digest; the first four have base spans.
KINDS = ["email", "ip", "card", "phone", "secret", "ssn"]
#: Gazetteers and context words of the labelers.
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|it|uk|eu|ch|at|be|nl"
PHONE_CODES = "1|33|34|44|49"
CARD_LEADS = "3[47]|4|5[1-5]|2[2-7]|6"
SECRET_NAMES = "token|secret|password|passwd|api_key|apikey|access_key|private_key|key"
CONTEXT = "mail|contact|phone|tel|mobile|call|card|visa|iban|account|host|server|address|token|secret|password|key|ssn"

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: The masked forms keep every code point's place: a separator that can stand inside a match becomes \x01,
#: so that patterns are plain runs of a class and can't exhaust the matcher's stack on long inputs.
EMAIL = "(?:(?<![A-Za-z0-9._%+\\x01-])|\\G)[A-Za-z0-9._%+\\x01-]++@[A-Za-z0-9-]++\\x01[A-Za-z0-9\\x01-]*+"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9][0-9\\x01]*[0-9]"
PHONE = "\\+[0-9][ ().0-9-]+[0-9]"
#: Looser candidates.
LONE_CARD = "(?<![0-9A-Za-z_])(?:[0-9]{12,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4})(?![0-9A-Za-z_])"
LOCAL_PHONE = "(?<![0-9+] ?)\\([0-9]{3}\\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
SECRET = "(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}+"
SSN = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

SPAN = "struct<kind:int,start:int,end:int,m:string,pre:string,post:string,base:boolean>"
NO_SPANS = f"cast(array() as array<{SPAN}>)"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, start: Column) -> Column:
    """Sums of an array up to each element, from ``start``."""
    def step(acc, x):
        return F.concat(acc, F.array(F.element_at(acc, -1) + x))

    return F.slice(F.aggregate(values, F.array(start), step), 2, F.size(values))


def prefix_sums(values: Column) -> Column:
    """Sums of an int array up to each element; blocks of about the square root of its size keep copying at n ** 1.5."""
    def blocked(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1), lambda k: F.slice(v, k * width + 1, width))
        zero = F.lit(0)

        def joined(own: Column) -> Column:
            before = F.concat(F.array(zero), _running(F.transform(own, lambda x: F.element_at(x, -1)), zero))
            return F.flatten(F.transform(own, lambda x, k: F.transform(x, lambda y: y + F.get(before, k))))

        return _let(F.transform(blocks, lambda x: _running(x, zero)), joined)

    return F.when(F.size(values) == 0, values).otherwise(_let(values, lambda v: F.when(F.size(v) <= 64, _running(v, F.lit(0))).otherwise(blocked(v))))


def find(text: Column, pattern: str, kind: str, good=None, base: bool = True) -> Column:
    """Leftmost non-overlapping matches as an array of spans; places count code points.

    Places come from the lengths of the pieces between matches, summed once.  ``good(match)`` drops failing
    matches.
    """
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def build(b: Column) -> Column:
        starts = prefix_sums(F.transform(b["m"], lambda m, i: F.char_length(F.get(b["p"], i)) + F.when(i > 0, F.char_length(F.get(b["m"], i - 1))).otherwise(0)))

        def spans(s: Column) -> Column:
            return F.transform(
                b["m"],
                lambda m, i: F.struct(
                    F.lit(KINDS.index(kind)).alias("kind"), F.get(s, i).alias("start"), (F.get(s, i) + F.char_length(m)).alias("end"), m.alias("m"),
                    F.lower(F.substring(F.get(b["p"], i), -24, 24)).alias("pre"), F.substring(F.get(b["p"], i + 1), 1, 1).alias("post"), F.lit(base).alias("base"),
                ),
            )

        found = F.when(F.size(b["m"]) > 0, _let(starts, spans)).otherwise(F.expr(NO_SPANS))
        return F.filter(found, lambda x: good(x["m"])) if good else found

    return _let(parts, build)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Luhn's check of the digits of ``m``."""
    def total(d):
        def step(acc, i):
            v = F.substring(d, -i, F.lit(1)).cast("int") * (1 + (i - 1) % 2)
            return acc + v - F.when(v > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.char_length(d)), F.lit(0), step) % 10 == 0

    return _let(digits(m), total)


def _count(m: Column, low: int, high: int) -> Column:
    return F.char_length(digits(m)).between(low, high)


def is_ip(m: Column) -> Column:
    return m.rlike(f"^{_OCTET}(?:\\.{_OCTET}){{3}}$")


def is_card(m: Column) -> Column:
    return F.when(_count(m, 12, 19), luhn(m)).otherwise(F.lit(False))


def is_phone(m: Column) -> Column:
    return _count(m, 9, 15)


def candidates(text: Column) -> Column:
    """Base spans and looser candidates of a text, as an array of spans."""
    plain = F.translate(text, "\x01", "\x02")
    dots = F.regexp_replace(plain, "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", "\x01")
    chains = F.regexp_replace(plain, "(?<=[0-9])[ -](?=[0-9])", "\x01")
    none = F.expr(NO_SPANS)
    return F.concat(
        F.when(F.instr(text, "@") > 0, find(dots, EMAIL, "email")).otherwise(none),
        F.when(
            text.rlike("[0-9]"),
            F.concat(
                F.when(text.rlike("[0-9]\\.[0-9]"), find(text, IP, "ip", is_ip)).otherwise(none),
                F.when(
                    text.rlike("[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]"),
                    F.concat(find(chains, CARD, "card", is_card), find(text, LONE_CARD, "card", base=False), find(text, SSN, "ssn", base=False)),
                ).otherwise(none),
                F.when(F.instr(text, "+") > 0, find(text, PHONE, "phone", is_phone)).otherwise(none),
                F.when(F.instr(text, "(") > 0, find(text, LOCAL_PHONE, "phone", base=False)).otherwise(none),
            ),
        ).otherwise(none),
        F.when(text.rlike(f"(?i)(?:{SECRET_NAMES})[\"']?[ ]?[=:]"), find(text, SECRET, "secret", base=False)).otherwise(none),
    )


VOTES = ["strict", "checksum", "gazetteer", "context", "boundary"]


def votes(x: Column) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 yes, 0 no, -1 abstains."""
    kind, m = x["kind"], x["m"]
    yes = lambda c: F.when(c, 1).otherwise(0)
    is_kind = lambda k: kind == KINDS.index(k)
    mixed = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return {
        "strict": F.when(x["base"], 1).when(is_kind("ssn"), yes(~m.rlike("^(?:000|666|9)|-00-|-0000$"))).otherwise(-1),
        "checksum": F.when(is_kind("card"), yes(is_card(m))).when(is_kind("ip"), yes(is_ip(m))).when(is_kind("secret"), yes(mixed & (F.size(F.array_distinct(F.split(m, ""))) >= 10))).otherwise(-1),
        "gazetteer": F.when(is_kind("email"), yes(m.rlike(f"(?:\\.|\x01)(?:{DOMAINS})$")))
        .when(is_kind("phone"), F.when(m.rlike(f"^\\+(?:{PHONE_CODES})[^0-9]"), 1).otherwise(-1))
        .when(is_kind("card"), F.when(m.rlike(f"^(?:{CARD_LEADS})"), 1).otherwise(-1))
        .when(is_kind("secret"), yes(x["pre"].rlike(f"(?:{SECRET_NAMES})[\"']?\\s*[=:]\\s*[\"']?$"))).otherwise(-1),
        "context": F.when(x["pre"].rlike(f"(?:{CONTEXT})[^a-z0-9]*$"), 1).otherwise(-1),
        "boundary": F.when(x["post"].rlike("[A-Za-z0-9_]") | x["pre"].rlike("[a-z0-9_]$"), 0).otherwise(-1),
    }


def features(x: Column) -> dict[str, Column]:
    """Features of the final classifier: the kind and what the span and its surroundings look like."""
    out = {f"is_{k}": (x["kind"] == i).cast("int") for i, k in enumerate(KINDS)}
    v = votes(x)
    out |= {f"{n}_{s}": (v[n] == c).cast("int") for n in VOTES for s, c in (("yes", 1), ("no", 0))}
    return out


def fit_votes(table: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> dict[tuple[int, tuple[int, ...]], float]:
    """Posterior that a span is real for each (kind, vote pattern), by expectation-maximisation.

    Two classes; a kind has its own prior; labelers are independent given the class, with
    Laplace-smoothed reliabilities; an abstention says nothing.  It starts at a majority vote.
    """
    post = {}
    for kind, pattern, _ in table:
        cast = [v for v in pattern if v >= 0]
        post[kind, pattern] = (1 + sum(cast)) / (2 + len(cast))
    for _ in range(rounds):
        prior, tell = {}, {}
        for kind, pattern, n in table:
            p = post[kind, pattern]
            a, b = prior.get(kind, (1.0, 1.0))
            prior[kind] = (a + n * p, b + n * (1 - p))
            for i, v in enumerate(pattern):
                if v >= 0:
                    for c, w in ((1, n * p), (0, n * (1 - p))):
                        tell.setdefault((i, c), [1.0, 1.0] if v >= 0 else None)
                        tell[i, c][v] += w
        for i, _v in enumerate(VOTES):  # a vote is never counted against what it says
            if (i, 1) in tell:
                yes, no = tell[i, 1][1] / sum(tell[i, 1]), tell[i, 0][1] / sum(tell[i, 0])
                if yes < no:
                    tell[i, 1], tell[i, 0] = [1.0, 1.0], [1.0, 1.0]
        new = {}
        for kind, pattern, _ in table:
            a, b = prior[kind]
            z = math.log(a / b)
            for i, v in enumerate(pattern):
                if v >= 0:
                    z += math.log(tell[i, 1][v] / sum(tell[i, 1])) - math.log(tell[i, 0][v] / sum(tell[i, 0]))
            new[kind, pattern] = 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))
        moved = max((abs(new[k] - post[k]) for k in new), default=0)
        post = new
        if moved < 1e-9:
            break
    return post


def fit_classifier(rows: list[tuple[list[int], float, int]], rounds: int = 500) -> list[float]:
    """Weights (bias last) of a logistic model with soft targets and counts, by Newton-free gradient steps."""
    if not rows:
        return []
    width, total = len(rows[0][0]), sum(math.log1p(n) for _, _, n in rows)
    w, pace = [0.0] * (width + 1), [1e-8] * (width + 1)
    for _ in range(rounds):
        g = [2e-3 * x for x in w]
        for x, y, n in rows:
            z = w[-1] + sum(wi for wi, xi in zip(w, x) if xi)
            e = (1 / (1 + math.exp(-max(-40.0, min(40.0, z)))) - y) * math.log1p(n) / total
            for i, xi in enumerate(x):
                if xi:
                    g[i] += e
            g[-1] += e
        for i, gi in enumerate(g):
            pace[i] += gi * gi
            w[i] -= 0.5 * gi / math.sqrt(pace[i])
    return w


def fit(spans: DataFrame) -> dict[str, float]:
    """Train on ``spans(x)``, all candidates of all documents; weights by feature, and ``bias``."""
    x = F.col("x")
    v, f = votes(x), features(x)
    counted = spans.select(x["kind"].alias("kind"), F.array(*(v[n] for n in VOTES)).alias("v"), F.array(*f.values()).alias("f")).groupBy("kind", "v", "f").count().collect()
    counted = sorted((r["kind"], tuple(r["v"]), tuple(r["f"]), r["count"]) for r in counted)
    merged: dict = {}
    for kind, pattern, _, n in counted:
        merged[kind, pattern] = merged.get((kind, pattern), 0) + n
    post = fit_votes([(k, p, n) for (k, p), n in merged.items()])
    w = fit_classifier([(list(fx), post[kind, pattern], n) for kind, pattern, fx, n in counted])
    return dict(zip([*f, "bias"], w))


def detect(documents: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, base counts, ``base_sha256``, ``spans`` and ``found`` (the spans as structs).

    One pass over the texts writes each document's candidates to the shared folder; vote patterns are counted and spans
    chosen from there.  Nothing is shuffled but pattern counts.  A null text is empty: no spans, and the digest of the empty
    string.  Repeated rows give repeated rows; an empty table an empty result; columns other than doc_id and
    text are ignored.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = scratch(docs.select("doc_id", candidates(F.col("text")).alias("c")), "candidates")
    w = fit(held.select(F.explode("c").alias("x")))

    def accept(x: Column) -> Column:
        z = F.lit(w.get("bias", 0.0))
        for name, c in features(x).items():
            z = z + F.lit(w.get(name, 0.0)) * c
        return x["base"] | (1 / (1 + F.exp(-z)) >= threshold)

    def place(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["base"].alias("base"))

    def joined(c: str, base: bool) -> Column:
        names = F.array(*(F.lit(k) for k in KINDS))
        chosen = F.filter(c, lambda x: x["base"]) if base else F.col(c)
        named = F.transform(chosen, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(named if base else F.array_distinct(named), ",")

    out = held.withColumn("found", F.sort_array(F.transform(F.filter("c", accept), place)))
    n = lambda k: F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == KINDS.index(k)))).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", n("email"), n("ip"), n("card"), n("phone"),
        F.sha2(joined("found", True).cast("binary"), 256).alias("base_sha256"), joined("found", False).alias("spans"), "found",
    )
