"""Secret scan with DataFrame functions only.

Three base patterns give spans; a candidate string (a long run of key
characters with a letter) adds spans where the Shannon entropy of a sliding
window reaches the threshold of the candidate's character class.  The entropy
is kept up by counts: a step changes the counts of the character that enters
and of the one that leaves.  Windows over nothing but allowed parts (words,
numbers, dates, UUIDs) add nothing.

Every step is an expression over one row: no shuffle, no Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns and the least lengths.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LEAST = 18
HEX = r"[0-9a-f]{16,}"

# Candidates, their classes (the first that fits counts) and least bits a character.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
CLASSES = (
    ("[0-9a-f]+|[0-9A-F]+", 3.0),
    ("[0-9a-z]+|[0-9A-Z]+", 3.5),
    ("[A-Za-z0-9+/_=-]+", 3.7),
)
# Text that looks random and is no secret.  A candidate is cut into parts at its
# delimiters; windows that touch allowed parts only add nothing.
DELIMITER = "[-_/+=]"
UUID = r"(?<![A-Za-z0-9])(?i:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})(?![A-Za-z0-9])"

def _one_case(letters: str, consonants: str, usual: str, rare: str) -> str:
    """Words of one case.  Those as long as a window must look like words: no four
    consonants in a row, and at most two rare letters."""
    return (rf"[{letters}]{{1,{WINDOW - 1}}}(?![{letters}])|(?![{letters}]*?[{consonants}]{{4}})"
            rf"(?!(?:[{usual}]*+[{rare}]){{3}})[{letters}]{{{WINDOW},}}")


# Words of one case or in camel case, without six consonants in a row, and a short number.
# Repeated groups are possessive: the regular expressions of the JVM match those in a loop, others by recursion.
_WORD = (r"(?![A-Za-z]*?(?i:[bcdfghjklmnpqrstvwxz]{6}))"
         rf"(?:{_one_case('a-z', 'bcdfghjklmnpqrstvwxz', 'abcdefghilmnoprstuy', 'jkqvwxz')}"
         rf"|{_one_case('A-Z', 'BCDFGHJKLMNPQRSTVWXZ', 'ABCDEFGHILMNOPRSTUY', 'JKQVWXZ')}"
         r"|[a-z]*(?:[A-Z]{1,6}[a-z]{2,}|(?:As|At|By|Do|Id|If|In|Is|My|No|Of|On|Or|To|Up))++[A-Z]{0,4})[0-9]{0,4}")
PARTS = (
    _WORD,
    r"[0-9]{1,8}|(?:19|20)[0-9]{10}(?:[0-9]{2})?",      # numbers, and dates with their parts or in one piece
    r"[0-9]{2,8}T[0-9]{2,6}Z?",                          # a day and the hour after it
    r"[0-9]{1,4}[A-Za-z]{1,2}|[A-Za-z0-9]{1,3}",
    r"0+|[xX]+|(?i:abcdefghijklmnopqrstuvwxyz|0123456789abcdef|0123456789|1234567890)++",
)
# Candidates of nothing but allowed parts.
ALLOWED = (rf"(?:{DELIMITER}*+(?:{UUID}|{'|'.join(PARTS)})(?![A-Za-z0-9]))*+{DELIMITER}*+",)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _running_sums(lengths: str, part: int = 256) -> str:
    """SQL for the sums of all elements before each, in parts so that long arrays stay cheap."""
    parts = f"transform(sequence(0, (size({lengths}) - 1) div {part}), p -> slice({lengths}, p * {part} + 1, {part}))"
    step = "named_struct('sum', s.sum + x, 'out', concat(s.out, array(s.sum)))"
    zero = "named_struct('sum', {0}, 'out', cast(array() as array<int>))"
    inner = f"aggregate(q, {zero.format('0')}, (s, x) -> {step}).out"
    bases = (f"aggregate(transform({parts}, q -> aggregate(q, 0, (s, x) -> s + x)), {zero.format('0')}, (s, x) -> {step}).out")
    return (f"CASE WHEN size({lengths}) = 0 THEN cast(array() as array<int>) ELSE "
            f"flatten(zip_with({parts}, {bases}, (q, base) -> transform({inner}, x -> x + base))) END")


def _pieces(text: str, found: str, pattern: str) -> str:
    """SQL for each match's length and the length of the text between it and the match before."""
    gaps = f"slice(split({text}, {_sql(pattern)}, -1), 1, size({found}))"
    return (f"CASE WHEN size({found}) = 0 THEN cast(array() as array<struct<gap:int,len:int>>) ELSE "
            f"zip_with({gaps}, {found}, (g, m) -> named_struct('gap', char_length(g), 'len', char_length(m))) END")


def _span(kind: int, start: str, end: str) -> str:
    return f"named_struct('start', {start}, 'kind', {kind}, 'end', {end})"


def _least(text: str) -> str:
    """SQL for the least bits a character of the text's class."""
    return "CASE " + " ".join(f"WHEN {text} RLIKE {_sql(f'^(?:{p})$')} THEN {v!r}D" for p, v in CLASSES) + " END"


def _marks(text: str) -> str:
    """SQL for one struct a character: where its part starts, the part's least bits and whether it is not allowed.

    A delimiter is a part of its own, which no window lies inside.
    """
    masked = f"regexp_replace({text}, {_sql(UUID)}, repeat('a', 36))"
    allowed = f"p RLIKE {_sql(f'^(?:{chr(124).join(PARTS)})$')}"
    part = f"array_repeat(named_struct('start', b, 'least', coalesce({_least('p')}, 99D), 'bad', NOT ({allowed})), char_length(p))"
    each = f"concat({part}, array(named_struct('start', b + char_length(p) + 1, 'least', 99D, 'bad', false)))"
    # Parts and lengths are bound as the only element of an array, so that they are worked out once.
    starts = f"flatten(transform(array(transform(parts, p -> char_length(p) + 1)), lengths -> {_running_sums('lengths')}))"
    return f"flatten(transform(array(split({masked}, {_sql(DELIMITER)}, -1)), parts -> flatten(zip_with(parts, {starts}, (p, b) -> {each}))))"


def _entropy(candidate: str) -> str:
    """SQL for the joined windows of one candidate (c.text, c.least) whose entropy is high enough, from 0.

    A window inside one part is held to that part's class.
    """
    weights = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 2)]
    g = "array(" + ", ".join(f"{w!r}D" for w in weights) + ")"
    chars = f"filter(split({candidate}.text, ''), x -> x <> '')"
    codes = (f"zip_with({chars}, slice({_marks(f'{candidate}.text')}, 1, char_length({candidate}.text)), (x, m) -> "
             f"named_struct('x', instr('{ALPHABET}', x), 'start', m.start, 'least', m.least, 'bad', m.bad))")
    zero = (f"named_struct('i', 0, 'counts', array_repeat(0, {len(ALPHABET)}), 'sum', 0D, 'bad', -1, 'from', -1, 'to', -1, "
            "'out', cast(array() as array<struct<from:int,to:int>>))")
    # left is the code that leaves (0: none), moved the sum of n log n afterwards.
    left = f"CASE WHEN s.i >= {WINDOW} THEN codes[s.i - {WINDOW}].x ELSE 0 END"
    leaving = f"s.counts[codes[s.i - {WINDOW}].x - 1]"
    moved = (f"s.sum + CASE WHEN e.x = ({left}) THEN 0D ELSE {g}[s.counts[e.x - 1] + 1] - {g}[s.counts[e.x - 1]] + "
             f"CASE WHEN s.i >= {WINDOW} THEN {g}[{leaving} - 1] - {g}[{leaving}] ELSE 0D END END")
    begins = f"s.i - {WINDOW - 1}"
    bad = "CASE WHEN e.bad THEN s.i ELSE s.bad END"
    high = (f"s.i >= {WINDOW - 1} AND {bad} >= {begins} AND {math.log2(WINDOW)!r}D - ({moved}) / {WINDOW} >= "
            f"CASE WHEN e.start <= {begins} THEN e.least ELSE {candidate}.least END")
    joins = f"s.to >= {begins}"
    step = (f"named_struct('i', s.i + 1, 'counts', transform(s.counts, (n, k) -> n + CASE WHEN k = e.x - 1 THEN 1 ELSE 0 END "
            f"- CASE WHEN k = ({left}) - 1 THEN 1 ELSE 0 END), 'sum', {moved}, 'bad', {bad}, "
            f"'from', CASE WHEN NOT ({high}) OR ({joins}) THEN s.from ELSE {begins} END, "
            f"'to', CASE WHEN {high} THEN s.i + 1 ELSE s.to END, "
            f"'out', CASE WHEN {high} AND NOT ({joins}) AND s.from >= 0 THEN concat(s.out, array(named_struct('from', s.from, 'to', s.to))) ELSE s.out END)")
    end = "CASE WHEN s.from >= 0 THEN concat(s.out, array(named_struct('from', s.from, 'to', s.to))) ELSE s.out END"
    return f"flatten(transform(array({codes}), codes -> aggregate(codes, {zero}, (s, e) -> {step}, s -> {end})))"


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind, end), code points, end
    exclusive, ordered by start and kind (see ``KINDS``).

    A null text counts as empty and has no spans; repeated rows each stay; an
    empty table gives an empty one.  An entropy span inside a base span is the
    same finding and is not listed again.
    """
    columns = docs.columns
    rows = docs.withColumn("__t", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    patterns = {"__assign": ASSIGN, "__access": ACCESS, "__hex": HEX, "__cand": CANDIDATE}
    rows = rows.select("*", *[F.expr(f"regexp_extract_all(__t, {_sql(p)}, 0)").alias(c) for c, p in patterns.items()])
    rows = rows.select("*", *[F.expr(_pieces("__t", c, p)).alias(f"{c}_len") for c, p in patterns.items()],
                       F.expr(f"CASE WHEN size(__assign) > 0 THEN regexp_extract_all(__t, {_sql(ASSIGN)}, 2) ELSE array() END").alias("__value"))
    rows = rows.select("*", *[F.expr(f"transform({c}_len, x -> x.gap + x.len)").alias(f"{c}_step") for c in patterns])
    rows = rows.select("*", *[F.expr(_running_sums(f"{c}_step")).alias(f"{c}_sum") for c in patterns])

    def spans(c: str, kind: int, keep: str = "true") -> str:
        each = f"zip_with({c}_sum, {c}_len, (b, x) -> {_span(kind, 'b + x.gap', 'b + x.gap + x.len')})"
        return f"filter({each}, (x, i) -> {keep})"

    base = (f"array_sort(concat({spans('__assign', 0, f'char_length(__value[i]) >= {ASSIGN_LEAST}')}, "
            f"{spans('__access', 1, f'x.end - x.start >= {ACCESS_LEAST}')}, {spans('__hex', 2)}))")
    allowed = " OR ".join(f"c.text RLIKE {_sql(f'^(?:{a})$')}" for a in ALLOWED)
    rows = rows.select("*", F.expr(base).alias("__base"), F.expr(
        f"filter(zip_with(zip_with(__cand, __cand_len, (m, x) -> named_struct('text', m, 'gap', x.gap, 'least', {_least('m')})), __cand_sum, "
        f"(c, b) -> named_struct('text', c.text, 'start', b + c.gap, 'least', c.least)), "
        f"c -> NOT ({allowed}))").alias("__kept"))
    extra = (f"flatten(transform(__kept, c -> transform({_entropy('c')}, w -> {_span(3, 'c.start + w.from', 'c.start + w.to')})))")
    rows = rows.select("*", F.expr(f"CASE WHEN size(__kept) > 0 THEN {extra} ELSE cast(array() as array<struct<start:int,kind:int,end:int>>) END").alias("__extra"))
    both = F.expr("array_sort(concat(__base, filter(__extra, e -> NOT exists(__base, b -> b.start <= e.start AND b.end >= e.end))))")
    return rows.select(*[F.col(f"`{c}`") for c in columns if c != "spans"], both.alias("spans"))


def span_summary(found: DataFrame) -> list[Column]:
    """Counts of the base kinds, the digest of the base spans and all spans as text."""
    spans = F.col("spans")
    count = [F.expr(f"cast(size(filter(spans, s -> s.kind = {n})) as long)").alias(f"n_{KINDS[n]}") for n in range(3)]
    base = _joined(F.filter(spans, lambda s: s["kind"] < 3))
    return [*count, F.sha2(base, 256).alias("base_sha256"), _joined(spans).alias("spans")]
