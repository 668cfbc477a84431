"""Document fingerprints by order MinHash, in built-in functions only.

A text is its words: letters of scripts that are written without blanks stand alone, other runs between white space
count as pieces of at most 12 code points.  Items are its ``K``-word k-mers, each numbered by its occurrence, so that
repeats are items of their own.  For each of ``SKETCHES`` functions the two least items are kept in the order in which
they stand in the text, and the pair is hashed to one coordinate (of a lone item, the item with itself).  The share of
equal coordinates of two fingerprints is their likeness; it falls when k-mers go, come or change order.

The functions come from rounds of hashing.  In a round every item has a fresh hash, which gives the function that it
goes to and its rank there; a function ranks items by (round, rank).  So one hash of an item serves all functions, and
each function goes on to fresh, independent draws until it has two items: one round for texts of some thousand words,
more for shorter ones.  After ``ROUNDS`` rounds a function ranks all items by hashes of its own.  More rounds than
needed change nothing, so texts of any sizes compare.  A text's draws are sorted once, as packed (function, round, rank, item) longs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SKETCHES = 128
K = 2
ROUNDS = 127
#: Draws that a text gets at first, if ``ROUNDS`` allow.
DRAWS = 10 * SKETCHES
#: Function and rank in a hash of 63 bits; the round's number stands between them, and an item's below.
ROUND = 1 << 49
HASHED = (127 << 56) | (((1 << 18) - 1) << 31)
#: Letters that are words by themselves (kana, Han, Thai and Lao).
LONE = "぀-ヿ㐀-䶿一-鿿฀-໿"
WORD = f"[{LONE}]|[^ \t\n\r\f{LONE}]{{1,12}}"
#: ``WORD`` as Java finds it fastest: a character of the first range is in no need of the nested class.
REST = r"\x21-\u0DFF[\x00-\x08\x0B\x0E-\x1F\u0F00-\u303F\u3100-\u33FF\u4DC0-\u4DFF\uA000-\x{10FFFF}]"
PATTERN = f"[{REST}]{{1,12}}|[{LONE}]"
#: Places and items' numbers take 31 bits, as arrays do.
LOW = (1 << 31) - 1


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: array<int> of ``SKETCHES`` coordinates of 16 bits; empty for a text without words.

    Every step is a column of its own and is read more than once by the next, so that the optimizer keeps
    it evaluated once for each row.
    """
    w, p, r, o, q, h, s, b, e, a = (f"_{name}_{out}" for name in "wproqhsbea")
    n, ahead = f"size({w})", ", ".join(f"get({w}, i + {j})" for j in range(1, K))

    def draws(rounds: str) -> str:
        """(function, round, rank, item) of every item in the rounds."""
        one = f"(shiftrightunsigned(xxhash64(x, k), 1) & {HASHED}L) | k | bigint(j)"
        return f"flatten(transform(sequence(0L, ({rounds} - 1) * {ROUND}L, {ROUND}L), k -> transform({h}, (x, j) -> {one})))"

    def begins(s: str, bits: int) -> str:
        """Where the runs start of equal values above the lowest ``bits`` in a sorted array of longs from 0 on; one comparison a value."""
        return f"if(size({s}) = 0, array(), concat(array(0), if(size({s}) = 1, array(), filter(sequence(1, size({s}) - 1), j -> ({s}[j] ^ {s}[j - 1]) >= {1 << bits}L))))"

    own = f"flatten(transform(sequence(0, {SKETCHES - 1}), f -> transform(transform({h}, x -> xxhash64(x, {ROUNDS} + 1 + f)), (v, j) -> shiftleft(bigint(f), 56) | shiftleft({ROUNDS}L, 49) | shiftleft(shiftrightunsigned(v, 46), 31) | bigint(j))))"
    # the first draw of another item than the first one: nearly always the next one
    end = "coalesce(get({b}, k + 1), size({s}))"
    seconds = (
        f"transform({{b}}, (f, k) -> if(f + 1 < {end} and ({n} > {DRAWS} or ({{s}}[f + 1] & {LOW}L) <> ({{s}}[f] & {LOW}L)), {{s}}[f + 1],"
        f" get(filter(slice({{s}}, f + 2, {end} - f - 1), v -> (v & {LOW}L) <> ({{s}}[f] & {LOW}L)), 0)))"
    )
    whole = f"{n} = 0 or size({{b}}) = {SKETCHES} and not exists({{e}}, v -> v is null)"
    several = seconds.replace(f"{n} > {DRAWS}", "false")
    rounds = f"least({ROUNDS}, 1 + {DRAWS} div {n})"
    steps = {
        w: f"regexp_extract_all(`{text}`, r'{PATTERN}', 0)",
        # k-mers in order of hash; equal k-mers in order of place
        p: f"sort_array(transform({w}, (x, i) -> shiftleft(shiftrightunsigned(xxhash64(x, {ahead}), 32), 31) | bigint(i)))",
        # where each run of equal k-mers starts
        r: begins(p, 31),
        # occurrence number of each
        o: f"if(size({r}) = {n}, array(), flatten(transform({r}, (s, k) -> sequence(0, coalesce(get({r}, k + 1), {n}) - s - 1))))",
        # items: later occurrences are hashed anew with their number
        q: f"if(size({r}) = {n}, {p}, transform({p}, (x, j) -> if({o}[j] = 0, x, shiftleft(shiftrightunsigned(xxhash64(shiftright(x, 31), {o}[j]), 32), 31) | (x & {LOW}L))))",
        h: f"transform({q}, x -> shiftright(x, 31))",
        f"{s}1": f"if({n} = 0, array(), sort_array({draws(rounds)}))",
        f"{b}1": begins(f"{s}1", 56),
        f"{e}1": seconds.format(s=f"{s}1", b=f"{b}1"),
        f"{a}1": whole.format(b=f"{b}1", e=f"{e}1"),
        f"{s}2": f"if({a}1, {s}1, sort_array({draws(f'least({ROUNDS}, 3 * {rounds})')}))",
        f"{b}2": f"if({a}1, {b}1, {begins(f'{s}2', 56)})",
        f"{e}2": f"if({a}1, {e}1, {several.format(s=f'{s}2', b=f'{b}2')})",
        f"{a}2": whole.format(b=f"{b}2", e=f"{e}2"),
        s: f"if({a}2, {s}2, sort_array(concat({draws(str(ROUNDS))}, {own})))",
        b: f"if({a}2, {b}2, {begins(s, 56)})",
        e: f"if({a}2, {e}2, {several.format(s=s, b=b)})",
    }
    for name, step in steps.items():
        df = df.withColumn(name, F.expr(step))
    pair = lambda x, y: f"xxhash64(shiftright({x}, 31), shiftright({y}, 31))"
    both = f"transform({b}, (f, k) -> named_struct('a', {q}[int({s}[f] & {LOW}L)], 'b', {q}[int(coalesce({e}[k], {s}[f]) & {LOW}L)]))"
    sig = f"transform({both}, t -> int(if((t.a & {LOW}L) <= (t.b & {LOW}L), {pair('t.a', 't.b')}, {pair('t.b', 't.a')}) & 65535L))"
    return df.withColumn(out, F.expr(sig)).drop(*steps)


def fingerprint(signature: str):
    """Coordinates as hexadecimal digits, four each."""
    return F.expr(f"array_join(transform(`{signature}`, x -> lpad(lower(hex(x)), 4, '0')), '')")


def likeness(a: str, b: str):
    """Share of equal coordinates; 1 for two texts without words, 0 for one."""
    same = f"aggregate(zip_with(`{a}`, `{b}`, (x, y) -> if(x = y, 1, 0)), 0, (t, x) -> t + x) / {SKETCHES}.0D"
    return F.expr(f"case when size(`{a}`) = 0 and size(`{b}`) = 0 then 1.0D when size(`{a}`) = 0 or size(`{b}`) = 0 then 0.0D else {same} end")


def _array(values: list, kind: str) -> Column:
    """A constant array of any length, as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def with_next(documents: DataFrame, rows_per_cell: int = 100, most_cells: int = 1 << 16) -> DataFrame:
    """``doc_id``, ``text`` and ``next_text``, the text of the next document in ascending order (after the last: the first).

    Documents go to cells between quantiles of doc_id, each cell to one window; the first document of a cell also
    goes, marked ``_guest``, to the last cell before it that has any.  The texts are shuffled once.  At most ``most_cells``
    cells, whose first ids go through the driver, hold equal shares of the documents, whatever the ids are like; a cell's rows are
    sorted and streamed, so that a share needn't fit in memory.
    Rows of equal doc_id are in order of text; null ids come first; a null text is empty.
    Guests stay in the result: they let a later ``lead`` over ``cell_order()`` see beyond a cell's end.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = docs.where("doc_id is not null").count()
    m = max(1, min(most_cells, -(-n // rows_per_cell)))
    # one expression for an array of any length
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", _array([k / m for k in range(m)], "double"), F.lit(10 * m))).first()[0] or []))
    steps = [1 << k for k in range(len(cuts).bit_length(), -1, -1)]
    at = F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda place, step: F.when((place + step <= len(cuts)) & (F.get(F.col("_cuts"), place + step - 1) <= F.col("doc_id")), place + step).otherwise(place),
    )
    docs = docs.withColumn("_cuts", _array(cuts, "bigint")).withColumn("_cell", F.when(F.col("doc_id").isNull(), 0).otherwise(at + 1)).drop("_cuts")
    firsts = sorted((r["_cell"], r["first"]) for r in docs.groupBy("_cell").agg(F.min("doc_id").alias("first")).collect())
    first, before = [None] * (len(cuts) + 2), [0] * (len(cuts) + 2)
    for k, (cell, value) in enumerate(firsts):
        first[cell], before[cell] = value, firsts[k - 1][0]
    is_first = F.col("doc_id").eqNullSafe(F.get(_array(first, "bigint"), F.col("_cell")))
    own = F.struct(F.col("_cell"), F.lit(0).alias("_guest"))
    guest = F.struct(F.get(_array(before, "int"), F.col("_cell")).alias("_cell"), F.lit(1).alias("_guest"))
    rows = docs.select("doc_id", "text", F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))).alias("_to")).select("doc_id", "text", "_to.*")
    return rows.withColumn("next_text", F.lead("text").over(cell_order()))


def cell_order():
    return Window.partitionBy("_cell").orderBy("_guest", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(documents: DataFrame, rows_per_cell: int = 100) -> DataFrame:
    """Fingerprint of each text and of its edited text, with their likenesses.

    The edited text: the last floor(n_chars / 2) code points replaced by the first as many (or all) of the
    next document.  Every row gives a row; a null or empty text has an empty fingerprint; an empty table
    gives an empty result; columns other than doc_id and text are ignored.
    """
    rows = with_next(documents, rows_per_cell).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.expr("concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(coalesce(next_text, ''), 1, int(n_chars div 2)))")
    rows = with_signature(rows.withColumn("edited", edited), "text", "own")
    rows = with_signature(rows, "edited", "changed")
    rows = rows.withColumn("following", F.lead("own").over(cell_order())).where("_guest = 0")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "following").alias("near_next"),
    )
