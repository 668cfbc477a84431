"""URL filters: empirical-Bayes host reputation with path rules on top.

Labelled page outcomes (bad or not) are counted for each host, registered domain and public suffix.  Each
level is a beta-binomial whose prior mean is the shrunken rate of the level above and whose strength is
estimated from the spread of the level's own rates (method of moments over all its members).  A host's
posterior is a beta distribution; the host is blocked if the lower bound of its bad rate
(mean - z standard deviations) is above ``excess`` times its suffix's rate, i.e. if it is all but certainly worse than
hosts of its suffix are.  Explicit rules go before the reputation.

Where pages come without outcomes, ``page_outcomes`` makes them from the visible text by three published rules
for web text: words of 3 to 10 characters on average, a letter in 80 % of the words at least, and at most
one ``#`` or ellipsis for ten words.  A page that breaks one of them is bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Fixed values: (action, host, path prefix).
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "ne.jp", "co.nz", "com.br", "co.za", "co.in", "com.mx"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

TAGS = r"(?is)<script.*?</script>|<style.*?</style>|<[^>]*>"
WORD, LETTERS, BLANKS, SYMBOLS = r"[^ \n\t]+", r"\p{L}[^ \n\t]*", " \n\t", "#…"
LEAST_WORDS, SHORT, LONG, LETTER_SHARE, SYMBOL_SHARE = 5, 3, 10, 80, 10
ADDRESS = r"^([0-9.]+|\[.*\]?)$"


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host between the first ``://`` and ``/ ? #``, A-Z lowered; path up to ``? #``."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits; both null if none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        rule, action = F.when(fits, name + prefix).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def domains(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix), without a port; a bare suffix or a name without dots is its own domain.

    A numeric address is its own domain, with the suffix ``address``.
    """
    name = F.regexp_replace(host, r"(.):[0-9]*$", "$1")
    numeric = name.rlike(ADDRESS)
    two = F.substring_index(name, ".", -2).isin(TWO_LABEL_SUFFIXES)
    suffix = F.when(numeric, "address").when(two, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    return F.when(numeric, name).when(two, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2)), suffix


def page_outcomes(pages: DataFrame) -> DataFrame:
    """``pages`` with ``outcome``: 1 if the visible text of ``html`` breaks a rule (see above), else 0.

    Null (no label) for a null page or one of under ``LEAST_WORDS`` words.
    """
    bad = "x.c < {0} * x.w or x.c > {1} * x.w or x.l * 100 < {2} * x.w or x.s * 100 > {3} * x.w".format(SHORT, LONG, LETTER_SHARE, SYMBOL_SHARE)
    # one expression, in which the text and its counts are bound once
    outcome = F.expr(
        f"""transform(transform(array(regexp_replace(html, r'{TAGS}', ' ')), t -> named_struct('w', regexp_count(t, r'{WORD}'), 'l', regexp_count(t, r'{LETTERS}'),
          'c', char_length(translate(t, '{BLANKS}', '')), 's', char_length(t) - char_length(translate(t, '{SYMBOLS}', '')))),
          x -> if(x.w >= {LEAST_WORDS}, cast({bad} as int), null))[0]"""
    )
    return pages.select("*", outcome.alias("outcome"))


def _strength(nodes: DataFrame, by: str) -> DataFrame:
    """Prior strength (pseudo-pages) of a level's members, from the spread of their rates within ``by``.

    Moments: with rate p_i over n_i pages and mean m, the variance of p_i is m(1-m)(rho + (1-rho)/n_i);
    the strength is 1/rho - 1, kept between 1 and 1000.  ``by`` has one row for each value.
    """
    m = F.sum("k") / F.sum("n")
    spread = F.sum(F.col("n") * (F.col("k") / F.col("n") - F.col("mean")) * (F.col("k") / F.col("n") - F.col("mean")))
    mean = nodes.groupBy(by).agg(m.alias("mean"))
    got = nodes.join(mean, by).groupBy(by).agg(
        F.first("mean").alias("mean"), spread.alias("ss"), F.count("*").cast("double").alias("g"), F.sum("n").cast("double").alias("nn"), F.sum(F.col("n") * F.col("n")).cast("double").alias("n2")
    )
    within = F.col("mean") * (1 - F.col("mean"))
    c = F.col("nn") - F.col("n2") / F.col("nn")
    rho = (F.col("ss") - within * (F.col("g") - 1)) / (within * (c - (F.col("g") - 1)))
    usable = (F.col("g") > 1) & (within > 0) & (c > F.col("g") - 1) & (rho > 0)
    return got.select(by, F.when(usable, F.least(F.greatest(1 / rho - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(1000.0).alias("strength"))


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """``outcomes(host, outcome)`` -> host, host_pages, host_bad, suffix_rate, host_strength, bad_rate (posterior mean), lower.

    Null outcomes don't count; hosts without a labelled page get no row.  Counts of hosts are written once
    and read by every level, so the outcomes are made once.
    """
    hosts = scratch(outcomes.where("host <> ''").groupBy("host").agg(F.count("outcome").alias("n"), F.sum("outcome").alias("k")).where("n > 0"), "hosts")
    domain, suffix = domains(F.col("host"))
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    level_domain = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    level_suffix = level_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("root", F.lit(1))
    root = level_suffix.groupBy("root").agg((F.sum("k") / F.sum("n")).alias("top"))
    suffixes = level_suffix.join(root, "root").join(_strength(level_suffix, "root"), "root").select(
        "suffix", ((F.col("k") + F.col("strength") * F.col("top")) / (F.col("n") + F.col("strength"))).alias("suffix_rate")
    )
    ds = level_domain.join(suffixes, "suffix").join(_strength(level_domain, "suffix"), "suffix").select(
        "domain", "suffix", "suffix_rate", ((F.col("k") + F.col("strength") * F.col("suffix_rate")) / (F.col("n") + F.col("strength"))).alias("above")
    )
    rate = F.col("a") / (F.col("a") + F.col("b"))
    return (
        hosts.join(ds, ["domain", "suffix"]).join(_strength(hosts, "domain"), "domain")
        .withColumn("a", F.col("k") + F.col("strength") * F.col("above"))
        .withColumn("b", F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("above")))
        .select(
            "host", F.col("n").alias("host_pages"), F.col("k").alias("host_bad"), "suffix_rate", F.col("strength").alias("host_strength"), rate.alias("bad_rate"),
            (rate - z * F.sqrt(rate * (1 - rate) / (F.col("a") + F.col("b") + 1))).alias("lower"),
        )
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, excess: float = 1.0, z: float = 1.645) -> DataFrame:
    """Verdict for each row of ``pages(page_id, url)``: the longest fitting rule's action, else the host's.

    A null url or one without ``://`` has an empty host and path, fits no rule and is allowed; a host
    without labelled pages is allowed.  Of rules of one length that fit (one host and path given twice) the last in the order of
    action counts, so ``block`` wins.  Repeated rows stay; other columns are ignored.  Rates are rounded to 6 digits, and null for a host without labelled pages.
    """
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    seen = host_reputation(outcomes, z)
    verdict = F.coalesce(F.col("_action"), F.when(F.col("lower") > excess * F.col("suffix_rate"), "block").otherwise("allow"))
    rates = [F.round(c, 6).alias(c) for c in ("suffix_rate", "host_strength", "bad_rate", "lower")]
    return (
        rows.withColumn("rule", rule).withColumn("_action", action).join(seen, "host", "left")
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("host_pages", F.lit(0)).alias("host_pages"), F.coalesce("host_bad", F.lit(0)).alias("host_bad"), *rates)
    )


def _strength_sql(nodes: str, by: str) -> str:
    return f"""select {by}, case when g > 1 and w > 0 and c > g - 1 and (ss - w * (g - 1)) / (w * (c - (g - 1))) > 0
        then least(greatest(1 / ((ss - w * (g - 1)) / (w * (c - (g - 1)))) - 1, 1.0), 1000.0) else 1000.0 end strength
      from (select {by}, any_value(mean) * (1 - any_value(mean)) w, sum(n * (k / n - mean) * (k / n - mean)) ss,
              count(*)::double g, sum(n)::double - sum(n * n)::double / sum(n)::double c
            from {nodes} join (select {by}, sum(k) / sum(n) mean from {nodes} group by {by}) using ({by}) group by {by})"""


ORACLE = rf"""
with u as (select page_id, html, coalesce(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end, '') rest from pages),
p as (select page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from u),
t as (select host, regexp_replace(html, '{TAGS}', ' ', 'g') x from p),
o as (select host, len(regexp_extract_all(x, '{WORD}')) w, len(regexp_extract_all(x, '{LETTERS}')) l, length(translate(x, ' \n\t', '')) c, length(x) - length(translate(x, '{SYMBOLS}', '')) s from t where x is not null),
h0 as (select host, count(*)::double n, sum(case when c < {SHORT} * w or c > {LONG} * w or l * 100 < {LETTER_SHARE} * w or s * 100 > {SYMBOL_SHARE} * w then 1 else 0 end)::double k from o where w >= {LEAST_WORDS} and host <> '' group by host),
h1 as (select host, n, k, regexp_replace(host, '(.):[0-9]*$', '\1') as name from h0),
h2 as (select *, regexp_matches(name, '{ADDRESS}') num, array_to_string(list_slice(string_split(name, '.'), -2, -1), '.') in ({', '.join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)}) two from h1),
hosts as (select host, n, k, case when num then name else array_to_string(list_slice(string_split(name, '.'), case when two then -3 else -2 end, -1), '.') end as domain,
  case when num then 'address' else array_to_string(list_slice(string_split(name, '.'), case when two then -2 else -1 end, -1), '.') end suffix from h2),
ld as (select domain, suffix, sum(n) n, sum(k) k from hosts group by all),
ls as (select suffix, sum(n) n, sum(k) k, 1 root from ld group by suffix),
sr as ({_strength_sql('ls', 'root')}), ss as ({_strength_sql('ld', 'suffix')}), sd as ({_strength_sql('hosts', 'domain')}),
a1 as (select suffix, (k + strength * (select sum(k) / sum(n) from ls)) / (n + strength) suffix_rate from ls join sr using (root)),
a2 as (select domain, suffix, suffix_rate, (k + strength * suffix_rate) / (n + strength) above from ld join a1 using (suffix) join ss using (suffix)),
r as (select host, n, k, suffix_rate, strength, k + strength * above a, n - k + strength * (1 - above) b from hosts join a2 using (domain, suffix) join sd using (domain)),
v as (select host, n, k, suffix_rate, strength, a / (a + b) rate, a / (a + b) - 1.645 * sqrt((a / (a + b)) * (1 - a / (a + b)) / (a + b + 1)) low from r),
f as (select page_id, host, path, case {' '.join(f"when (host = '{n}' or host like '%.{n}') and starts_with(path, '{q}') then '{a}|{n}{q}'" for a, n, q in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)))} end hit from p)
select page_id, host, path, split_part(hit, '|', 2) as rule, coalesce(split_part(hit, '|', 1), case when low > suffix_rate then 'block' else 'allow' end) verdict,
  coalesce(n, 0)::bigint host_pages, coalesce(k, 0)::bigint host_bad, round(suffix_rate, 6) suffix_rate, round(strength, 6) host_strength, round(rate, 6) bad_rate, round(low, 6) lower
from f left join v using (host)
"""
