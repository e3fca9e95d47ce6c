"""Personal data in texts: exact base patterns, and bootstrapped contextual
extraction of identifiers the patterns do not know.

Base: e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone
numbers, with exact positions.  Bootstrapping: the base matches are seeds;
the words around them induce lexical patterns; patterns and the strings they
surround form a bipartite graph which is scored in a few rounds of joins;
strings of high score that the base patterns missed are added as spans of the
kind.  A text is a row of words, cut where a base match begins or ends, with
short numbers parted by one space taken together.  Plain words (letters) and
plain numbers, dates and times are known to be no identifiers: they and the
strings of other kinds are the evidence against a pattern, all other strings
are candidates and count neither way.  A pattern is as good as its evidence, a
string as good as its patterns together make it.

Only built-in column functions, aggregations and equi-joins are used.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_broadcast, saved

KINDS = ("email", "ip", "card", "phone")

# The contract's expressions, written so that a run is entered only at its
# start or where the last match ended (\G), with possessive repeats: the same
# leftmost matches, in linear time and constant stack on any text.
_PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the expression to be worth trying.
_NEEDS = {
    "email": "contains(text, '@')",
    "ip": "has_digit and contains(text, '.')",
    "card": "has_digit",
    "phone": "has_digit and contains(text, '+')",
}
_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{2,4}"
_GROUP = rf"(?!(?:{_DATE})[,.;]?(?!\S))(?:[^\s\p{{L}}@0-9]*+[0-9]){{1,6}}+[^\s\p{{L}}@0-9]*+(?!\S)"
# Words; those of at most six digits and no letter are one with their like (as in cards and phone numbers).
_TOKEN = rf"(?<!\S){_GROUP}(?:\x20{_GROUP})++|\S++"
_EDGE = r"^[^0-9\p{L}+(@]+|[^0-9\p{L})@]+$"
_WORD = r"^\p{L}+(?:[\x27’-]\p{L}+)*$"
_NUMBER = rf"^(?:[+-]?[0-9]{{1,6}}(?:[.,][0-9]+)?|{_DATE}|[0-9]{{1,2}}(?::[0-9]{{2}}){{1,2}})$"


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'"


def _located(m: str, g: str, chunk: int = 256) -> str:
    """SQL: positions of the matches `m` of a text cut by them into the gaps
    `g`.  Running sums in chunks, so that many matches cost little more than
    few: array<struct<s, e, v>>."""
    empty = "cast(array() as array<struct<s: bigint, e: bigint, v: string>>)"
    step = f"""aggregate(sequence(c * {chunk}, least((c + 1) * {chunk}, size({m})) - 1), {empty}, (a, i) ->
        concat(a, array(named_struct(
            's', coalesce(try_element_at(a, -1).e, 0L) + length({g}[i]),
            'e', coalesce(try_element_at(a, -1).e, 0L) + length({g}[i]) + length({m}[i]), 'v', {m}[i]))))"""
    chunks = f"transform(sequence(0, (size({m}) - 1) div {chunk}), c -> {step})"
    shifted = f"""aggregate({chunks}, named_struct('off', 0L, 'all', cast(array() as array<{'array<struct<s: bigint, e: bigint, v: string>>'}>)),
        (a, ch) -> named_struct('off', a.off + element_at(ch, -1).e,
            'all', concat(a.all, array(transform(ch, x -> named_struct('s', x.s + a.off, 'e', x.e + a.off, 'v', x.v))))),
        a -> flatten(a.all))"""
    return f"case when size({m}) > 0 then {shifted} else {empty} end"


_DIGITS = "regexp_replace(x.v, '[^0-9]', '')"
# Luhn over the digits from the right: every second digit doubled, less 9 above 9.
_LUHN = f"""aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + case when i % 2 = 1
    then cast(substr(reverse({_DIGITS}), i, 1) as int)
    else cast(substr(reverse({_DIGITS}), i, 1) as int) * 2
         - case when cast(substr(reverse({_DIGITS}), i, 1) as int) > 4 then 9 else 0 end end) % 10 = 0"""
_VALID = {
    "email": "true",
    "ip": "forall(split(x.v, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
    "card": f"case when length({_DIGITS}) between 13 and 19 then {_LUHN} else false end",
    "phone": f"length({_DIGITS}) between 9 and 15",
}


# A plain word among tokens that are a line each (what `_EDGE` leaves of it is a `_WORD`).
_PLAIN = r"(?md)^[^0-9\p{L}+(@\n]*+\p{L}++(?:[\x27’-]\p{L}++)*+[^0-9\p{L})@\n]*+$"
_WHITE = r"' \t\n\r\u000B\u000C'"
_STEP = 32      # tokens between two of the positions that are kept
_PART = 16      # one text in so many is read first for evidence against patterns


def _tokens(t: DataFrame) -> DataFrame:
    """`t` (text, has_digit) with m, the tokens of the text; n, their number;
    c, their forms as context (of a long token its last 40 code points);
    other, the tokens with '' for each plain word.  What concerns all tokens
    is done on them as one string of lines, not token by token."""
    none = "cast(array() as array<string>)"
    lines = lambda e: f"case when n > 0 then split({e}, '\\n', -1) else {none} end"
    t = t.withColumn("w", F.expr(rf"""case when has_digit then regexp_extract_all(text, r'(?:{_TOKEN})\s*+', 0)
        else regexp_extract_all(text, r'\S++\s*+', 0) end"""))
    t = t.withColumn("m", F.expr(f"transform(w, x -> trim(trailing {_WHITE} from x))")).withColumn("n", F.size("w"))
    t = t.withColumn("lines", F.array_join("m", "\n"))
    t = t.withColumn("c", F.expr(lines("lower(translate(lines, '123456789', '000000000'))")))
    t = t.withColumn("c", F.expr("case when exists(m, x -> length(x) > 40) then transform(c, x -> right(x, 40)) else c end"))
    return t.withColumn("other", F.expr(lines(f"regexp_replace(lines, {_quoted(_PLAIN)}, '')")))


def _placed(t: DataFrame) -> DataFrame:
    """`t` with what `_start` needs: the lengths of the tokens with the white
    space behind them, and the position of every `_STEP`th."""
    t = t.withColumn("lens", F.expr("transform(w, x -> length(x))"))
    sums = f"""transform(sequence(0, (n - 1) div {_STEP}), k -> aggregate(slice(lens, cast(k * {_STEP} + 1 as int), {_STEP}), 0L, (a, l) -> a + l))"""
    lead = r"cast(length(text) - length(trim(leading " + _WHITE + r" from text)) as bigint)"
    return t.withColumn("at", F.expr(f"""case when n = 0 then cast(array() as array<bigint>) else
        aggregate({sums}, array({lead}), (a, x) -> concat(a, array(element_at(a, -1) + x))) end"""))


def _start(i: str) -> str:
    """SQL: position of token i."""
    return f"""(at[cast({i} div {_STEP} as int)] + aggregate(slice(lens, cast({i} div {_STEP} as int) * {_STEP} + 1,
        cast({i} % {_STEP} as int)), 0L, (a, l) -> a + l))"""


def _form(v: str) -> str:
    """SQL: a part of a word as context (of a long one the last 40 code
    points), '' if only signs are left."""
    return f"lower(regexp_replace(right(regexp_replace({v}, {_quoted(_EDGE)}, ''), 40), '[0-9]', '0'))"


def _left2(i: str, head: str = "''") -> str:
    """SQL: the two tokens before token i (the nearer is `head`, the part of
    the token before the string, if it holds a word), '' if there are fewer."""
    return f"""case when {head} <> '' and {i} >= 1 then concat(c[{i} - 1], ' ', {head}) when {head} <> '' then ''
        when {i} >= 2 then concat(c[{i} - 2], ' ', c[{i} - 1]) else '' end"""


def _around(i: str, j: str, head: str = "''", tail: str = "''") -> str:
    """SQL: the token before token i and the token j, or the parts of the
    string's own token before and after it."""
    return f"""concat(case when {head} <> '' then {head} when {i} >= 1 then c[{i} - 1] else '' end, ' _ ',
        case when {tail} <> '' then {tail} when {j} < size(c) then c[{j}] else '' end)"""


def _patterns(l2: F.Column, l1r1: F.Column) -> F.Column:
    """Both patterns of an occurrence, null where a text has no such words."""
    return F.array(F.concat(F.lit("l2 "), F.nullif(l2, F.lit(""))), F.concat(F.lit("l1r1 "), F.nullif(l1r1, F.lit(" _ "))))


def plain_words(docs: DataFrame, patterns: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, n_words): distinct plain words in each of the `patterns`."""
    t = docs.select(F.col(f"`{text}`").alias("text")).where("text <> ''")
    t = _tokens(t.withColumn("has_digit", F.col("text").rlike("[0-9]")))
    # first the nearest word on the left, which is part of either pattern, then the patterns themselves
    known = bounded_broadcast(patterns)
    left = bounded_broadcast(saved(patterns.select(F.expr(
        "case when pattern like 'l2 %' then substring_index(pattern, ' ', -1) else split(pattern, ' ')[1] end").alias("l1")).distinct(), "pii-left"))
    occ = t.select(F.explode(F.expr("""transform(filter(sequence(0, n - 1), i -> n > 0 and other[i] = ''), i -> named_struct(
        'value', m[i], 'two', case when i >= 2 then c[i - 2] end, 'l1', case when i >= 1 then c[i - 1] else '' end,
        'next', case when i + 1 < n then c[i + 1] else '' end))""")).alias("u")).select("u.*")
    # words behind numbers taken together are kept, too; the texts are read once
    near = occ.join(left.withColumn("near", F.lit(True)), "l1", "left").where(F.col("near") | F.col("l1").contains(" "))
    occ = near.select(F.expr(f"lower(regexp_replace(value, {_quoted(_EDGE)}, ''))").alias("value"), F.explode(_patterns(
        F.expr("case when two is not null then concat(two, ' ', l1) else '' end"),
        F.expr("concat(l1, ' _ ', next)"))).alias("pattern")).where("pattern is not null")
    return occ.join(known, "pattern").distinct().groupBy("pattern").agg(F.count(F.lit(1)).alias("n_words"))


def located_base(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, email, ip, card, phone, units): per row the base
    spans of each kind, and the strings that are not plain words with their contexts.
    row_key is equal only for rows with equal id and text."""
    t = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    t = t.withColumn("has_digit", F.col("text").rlike("[0-9]"))
    none = "cast(array() as array<string>)"
    for k in KINDS:
        t = (t.withColumn("m", F.expr(f"case when {_NEEDS[k]} then regexp_extract_all(text, {_quoted(_PATTERN[k])}, 0) else {none} end"))
             .withColumn("g", F.expr(f"case when size(m) > 0 then split(text, {_quoted(_PATTERN[k])}, -1) else {none} end"))
             .withColumn("p", F.expr(_located("m", "g")))
             .withColumn(k, F.expr(f"filter(p, x -> {_VALID[k]})")).drop("m", "g", "p"))
    t = _placed(_tokens(t))
    # base spans: i tokens lie before each, and j begin before its end; found from the kept positions and the tokens behind one
    base = ", ".join(f"""transform({k}, b -> named_struct('s', b.s, 'e', b.e, 'v', b.v, 'kind', {i}))""" for i, k in enumerate(KINDS))
    t = t.withColumn("b", F.expr(f"concat({base})"))
    behind = lambda k: f"sequence({k} * {_STEP}, least(n, {k} * {_STEP} + {_STEP}) - 1)"
    t = t.withColumn("b", F.expr(f"""transform(transform(b, x -> named_struct('x', x,
        'k', size(filter(at, q -> q <= x.s)) - 1, 'l', size(filter(at, q -> q < x.e)) - 1)),
        y -> named_struct('x', y.x, 'i', y.k * {_STEP} + size(filter({behind("y.k")}, u -> {_start("u")} + length(m[u]) <= y.x.s)),
            'j', y.l * {_STEP} + size(filter({behind("y.l")}, u -> {_start("u")} < y.x.e))))"""))
    t = t.withColumn("seeds", F.expr(f"""transform(transform(b, y -> named_struct('x', y.x, 'i', y.i, 'j', y.j,
            'h', {_form(f"right(substr(m[y.i], 1, cast(y.x.s - {_start('y.i')} as int)), 60)")},
            'r', {_form(f"substr(m[y.j - 1], cast(y.x.e - {_start('(y.j - 1)')} + 1 as int), 60)")})),
        y -> named_struct('s', y.x.s, 'v', y.x.v, 'l2', {_left2("y.i", "y.h")}, 'l1r1', {_around("y.i", "y.j", "y.h", "y.r")},
            'kind', y.x.kind))"""))
    # plain words are most of a text and are dropped first; o: the base spans that meet a word, looked up in groups of 64
    t = t.withColumn("met", F.expr("array_sort(transform(b, y -> named_struct('i', y.i, 'j', y.j, 's', y.x.s, 'e', y.x.e)))"))
    t = t.withColumn("met", F.expr("""case when size(met) > 0 then transform(sequence(0, (size(met) - 1) div 64), k -> named_struct(
        'lo', met[cast(k * 64 as int)].i, 'hi', array_max(slice(met, cast(k * 64 + 1 as int), 64).j), 'all', slice(met, cast(k * 64 + 1 as int), 64))) end"""))
    meets = "flatten(transform(filter(met, g -> g.lo <= z.i and z.i < g.hi), g -> filter(g.all, y -> y.i <= z.i and z.i < y.j)))"
    none_met = "cast(array() as array<struct<i: int, j: int, s: bigint, e: bigint>>)"
    kept = f"""transform(transform(filter(sequence(0, n - 1), i -> n > 0 and other[i] <> ''), i -> named_struct('i', i, 's', {_start("i")})),
        z -> named_struct('x', named_struct('s', z.s, 'e', z.s + length(m[z.i]), 'v', m[z.i]), 'i', z.i,
            'o', case when met is null then {none_met} else {meets} end))"""
    # the parts of a word outside them: between the sorted ends and the sorted starts
    kept = f"transform({kept}, z -> named_struct('x', z.x, 'i', z.i, 'o', z.o, 'ends', array_sort(z.o.e), 'starts', array_sort(z.o.s)))"
    bounds = """transform(sequence(0, size(z.o)), k -> named_struct(
        's', case when k = 0 then z.x.s else greatest(z.x.s, z.ends[k - 1]) end,
        'e', case when k = size(z.o) then z.x.e else least(z.x.e, z.starts[k]) end))"""
    parts = f"""case when size(z.o) = 0 then array(named_struct('s', z.x.s, 'e', z.x.e, 'v', z.x.v, 'h', '', 'r', ''))
        else transform(filter({bounds}, q -> q.e > q.s), q -> named_struct('s', q.s, 'e', q.e,
            'v', substr(z.x.v, cast(q.s - z.x.s + 1 as int), cast(q.e - q.s as int)),
            'h', {_form("right(substr(z.x.v, 1, cast(q.s - z.x.s as int)), 60)")},
            'r', {_form("substr(z.x.v, cast(q.e - z.x.s + 1 as int), 60)")})) end"""
    part = rf"""named_struct(
        's', q.s + length(q.v) - length(regexp_replace(q.v, r'^[^0-9\p{{L}}+(@]+', '')), 'v', regexp_replace(q.v, {_quoted(_EDGE)}, ''),
        'l2', {_left2('z.i', 'q.h')}, 'l1r1', {_around('z.i', 'z.i + 1', 'q.h', 'q.r')}, 'kind', -1)"""
    t = t.withColumn("units", F.expr(f"""concat(seeds, filter(flatten(transform({kept}, z -> transform({parts}, q -> {part}))),
        u -> u.v <> '' and not u.v rlike {_quoted(_WORD)}))"""))
    strip = {k: F.expr(f"transform({k}, x -> named_struct('s', x.s, 'e', x.e))").alias(k) for k in KINDS}
    return t.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), *strip.values(), "units")


def bootstrap(located: DataFrame, docs: DataFrame, text: str = "text", rounds: int = 3, support: int = 3,
              pattern_score: float = 0.9, accept: float = 0.95) -> DataFrame:
    """(value, kind, score) of the strings that patterns vouch for and the
    base patterns do not know.  A pattern counts for a kind once `support`
    distinct strings of the kind stand in it and they are at least
    `pattern_score` of its evidence: strings of any kind, plain words and plain
    numbers.  Equal scores go to the kind listed first.  Without seeds the
    result is empty."""
    u = located.select(F.explode("units").alias("u")).select("u.*").where("v <> ''")
    edges = u.select(F.lower("v").alias("value"), "kind", F.explode(_patterns(F.col("l2"), F.col("l1r1"))).alias("pattern"))
    edges = edges.where("pattern is not null")
    edges = saved(edges.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-edges")
    seeds = saved(edges.where("kind >= 0").select("value", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1).alias("kind"),
                                                  F.lit(1.0).alias("score")).distinct(), "pii-seeds")
    plain = edges.select("pattern", "value", F.expr(f"kind < 0 and value rlike {_quoted(_NUMBER)}").alias("number"))
    strings = plain.where("not number").select("pattern", "value")
    numbers = plain.groupBy("pattern").agg(F.sum(F.col("number").cast("long")).alias("against"))

    def able(against: DataFrame, name: str) -> DataFrame:
        """What may come to count in any round, by evidence that is not less
        than `against`: patterns of enough seeds, then of enough strings in such patterns.  The
        weight of a pattern is at most the number of these strings."""
        reach = seeds.select("value").distinct()
        for r in range(rounds):
            held = strings.join(reach, "value").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
            may = saved(held.join(against, "pattern").where(F.col("n") >= (pattern_score - 1e-9) * (F.col("n") + F.col("against")))
                        .select("pattern"), f"pii-{name}-{r}")
            if r < rounds - 1:
                reach = saved(strings.join(may, "pattern").select("value").union(reach).distinct(), f"pii-{name}-reach-{r}")
        return may

    def with_words(some: DataFrame, patterns: DataFrame, name: str) -> DataFrame:
        words = plain_words(some, patterns, text)
        return saved(numbers.join(patterns, "pattern").join(words, "pattern", "left").select(
            "pattern", (F.col("against") + F.coalesce("n_words", F.lit(0))).alias("against")), name)

    # most patterns are ruled out by the words of some texts alone; all words are counted for the others
    first = able(numbers, "able")
    some = docs.where(F.expr(f"pmod(xxhash64(`{text}`), {_PART}) = 0"))
    able_now = able(with_words(some, first, "pii-against-some"), "left")
    against = with_words(docs, able_now, "pii-against")
    plain = plain.join(able_now, "pattern")
    plain = saved(plain.where("not number").select("pattern", "value"), "pii-plain")
    belief = seeds
    for r in range(rounds):
        weight = saved(plain.join(belief, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("f")), f"pii-weight-{r}")
        good = (weight.join(weight.groupBy("pattern").agg(F.sum("f").alias("all")), "pattern").where(F.col("f") >= support)
                .join(against, "pattern").withColumn("conf", F.col("f") / (F.col("all") + F.col("against")))
                .where(F.col("conf") >= pattern_score))
        scored = (plain.join(good.select("pattern", "kind", "conf"), "pattern").groupBy("value", "kind")
                  .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("conf"), F.lit(1e-6)))))).alias("score")))
        news = scored.join(seeds.select("value").distinct(), "value", "left_anti")
        belief = saved(seeds.unionByName(news), f"pii-belief-{r}")
    order = F.expr("case kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS)) + " end")
    best = (belief.join(seeds.select("value").distinct(), "value", "left_anti").where(F.col("score") >= accept)
            .groupBy("value").agg(F.max(F.struct("score", -order)).alias("b")))
    return best.select("value", F.element_at(F.array(*map(F.lit, KINDS)), 1 - F.col("b.col2")).alias("kind"),
                       F.col("b.score").alias("score"))


def find(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, email, ip, card, phone, found): one row per row of `docs`.
    The first four are the base spans (array of s, e), `found` the spans
    added by bootstrapping (kind, s, e, score), which overlap no base span.
    A token counts as context by its last 40 code points, the parts of a token
    before and behind a span by the 60 nearest it.
    Null and empty texts have no spans; rows may repeat; a null id is an id
    like others; an empty table gives an empty result."""
    located = saved(located_base(docs, doc, text), "pii-located")
    accepted = bootstrap(located, docs, text, **options)
    units = (located.select("row_key", F.explode("units").alias("u")).where("u.kind < 0")
             .select("row_key", F.col("u.s").alias("s"), (F.col("u.s") + F.length("u.v")).alias("e"),
                     F.lower("u.v").alias("value")))
    added = (units.join(bounded_broadcast(saved(accepted, "pii-accepted")), "value")
             .groupBy("row_key").agg(F.array_sort(F.collect_set(F.struct("kind", "s", "e", "score"))).alias("found")))
    return (located.join(added, "row_key", "left")
            .select("doc_id", *KINDS, F.coalesce("found", F.expr(
                "cast(array() as array<struct<kind: string, s: bigint, e: bigint, score: double>>)")).alias("found")))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts, digest and text form of the spans of `find`."""
    def named(kind: str):
        return lambda x: F.concat_ws(":", F.lit(kind), x["s"], x["e"])

    def listed(extra: bool):
        parts = []
        for k in KINDS:
            own = F.expr(f"transform({k}, x -> named_struct('s', x.s, 'e', x.e))")
            if extra:
                own = F.array_sort(F.concat(own, F.expr(
                    f"transform(filter(found, x -> x.kind = '{k}'), x -> named_struct('s', x.s, 'e', x.e))")))
            parts.append(F.transform(own, named(k)))
        return F.array_join(F.concat(*parts), ",")
    return found.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(listed(False), 256).alias("base_sha256"), listed(True).alias("spans"),
                        F.size("found").cast("long").alias("n_found"))
