"""Spelling variants: words one edit apart, by finite-state composition.

The vocabulary acceptor is composed with a transducer of one edit (a replaced or
an inserted code point) and with the vocabulary acceptor again; accepted paths of
the composition are the pairs of near words.  A path that has not used its edit
yet is in one state of the acceptor twice, so the work divides by the state where
a path enters: words are grouped by their first half, and the composition starts
from the state that this half leads to.  Pairs that differ in the first half share
the second one; they are found by the same composition over reversed words.

With m the shorter length of a pair, the first half is m // 2 code points.  A
word of length l therefore lies in the groups of m = l and m = l - 1, and each
pair is accepted in exactly one group: forwards if the first halves are equal,
else backwards.  A group's acceptor is minimised; a group of more than
``GROUP_WORDS`` words is cut into chunks, and every pair of chunks is composed on
its own.  Words leave a group with their number of partners and the best one, so
pairs are never written.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_stream, materialize

LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
TYPO_EVERY = 199
GROUP_WORDS = 20_000
RUNS = r"([A-Za-zÀ-ÿ]+)"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def with_typos(run: Column, doc_id: Column) -> Column:
    """The run, less one code point where the contract's hash of document and run says so.

    A row without a document id has no such hash: its runs stay.
    """
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % TYPO_EVERY == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))) \
        .otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of enough code points and occurrences over all whole texts."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUNS))).alias("run")) \
        .where(F.char_length("run") >= least_length).select("id", lower_ascii(F.col("run")).alias("run"))
    return runs.select(with_typos(F.col("run"), F.col("id")).alias("word")) \
        .where(F.char_length("word") >= least_length) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


class Acceptor:
    """Minimal acyclic automaton of words given in ascending order, each once.

    ``final[s]`` and ``arcs[s]``: character -> (state, number of the state's words
    that come before those behind the arc).  The numbers along a path add up to
    the position of its word.
    """

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.sizes: list[int] = []
        self.known: dict[tuple, int] = {}
        # The path of the last word: (final, arcs so far, character of the open arc).
        path: list[list] = [[False, [], None]]
        last = ""
        for word in words:
            common, most = 0, min(len(word), len(last))
            while common < most and word[common] == last[common]:
                common += 1
            self._close(path, common)
            for c in word[common:]:
                path[-1][2] = c
                path.append([False, [], None])
            path[-1][0] = True
            last = word
        self._close(path, 0)
        self.start = self._state(path[0])

    def _close(self, path: list[list], depth: int) -> None:
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1][1].append((path[-1][2], state))

    def _state(self, open_state: list) -> int:
        """The state with these arcs, one for all that accept the same."""
        final, arcs, _ = open_state
        key = (final, *arcs)
        state = self.known.get(key)
        if state is None:
            state = self.known[key] = len(self.final)
            size, out = int(final), {}
            for c, target in arcs:
                out[c] = target, size
                size += self.sizes[target]
            self.final.append(final)
            self.arcs.append(out)
            self.sizes.append(size)
        return state


def _meet(a: Acceptor, b: Acceptor, s: int, t: int, i: int, j: int) -> Iterator[tuple[int, int]]:
    """Positions of the words that go on alike from both states."""
    todo = [(s, t, i, j)]
    while todo:
        s, t, i, j = todo.pop()
        if a.final[s] and b.final[t]:
            yield i, j
        there = b.arcs[t]
        for c, (s2, di) in a.arcs[s].items():
            if c in there:
                t2, dj = there[c]
                todo.append((s2, t2, i + di, j + dj))


def replaced(a: Acceptor, b: Acceptor) -> Iterator[tuple[int, int]]:
    """Positions of word pairs that differ by one replaced character; where both
    acceptors are the same, each pair once."""
    same = a is b
    todo = [(a.start, b.start, 0, 0)]
    while todo:
        s, t, i, j = todo.pop()
        there = b.arcs[t]
        for c, (s2, di) in a.arcs[s].items():
            for d, (t2, dj) in there.items():
                if c == d:
                    todo.append((s2, t2, i + di, j + dj))
                elif c < d or not same:
                    yield from _meet(a, b, s2, t2, i + di, j + dj)


def inserted(a: Acceptor, b: Acceptor) -> Iterator[tuple[int, int]]:
    """Positions of word pairs of which the second has one character more, each
    once: the insertion is read where the two first differ."""
    todo = [(a.start, b.start, 0, 0)]
    while todo:
        s, t, i, j = todo.pop()
        here, there = a.arcs[s], b.arcs[t]
        for extra, (t2, dj) in there.items():
            if a.final[s] and b.final[t2]:
                yield i, j + dj
            after = b.arcs[t2]
            for c, (s3, di) in here.items():
                if c != extra and c in after:
                    t3, dj3 = after[c]
                    yield from _meet(a, b, s3, t3, i + di, j + dj + dj3)
        for c, (s2, di) in here.items():
            if c in there:
                t2, dj = there[c]
                todo.append((s2, t2, i + di, j + dj))


class _Side:
    """The words of one chunk of a group, by length, with their acceptors."""

    def __init__(self, members: list[tuple[str, int]], backwards: bool, m: int):
        self.acceptors, self.words = [], []
        for length in (m, m + 1):
            mine = sorted((w[:length - (m - m // 2)][::-1] if backwards else w[m // 2:], w, n) for w, n in members if len(w) == length)
            self.words.append([(w, n) for _, w, n in mine])
            self.acceptors.append(Acceptor([rest for rest, _, _ in mine]))


def _near_in_group(chunks: list[list[tuple[str, int]]], backwards: bool, m: int) -> Iterator[tuple]:
    """(word, number of near words, n of the best, the best) within one chunk or between two."""
    found: dict[str, list] = {}
    half = m // 2

    def link(u: tuple[str, int], v: tuple[str, int]) -> None:
        if backwards and u[0][:half] == v[0][:half]:
            return  # accepted forwards
        for (word, _), (other, n) in ((u, v), (v, u)):
            best = found.setdefault(word, [0, -n, other])
            best[0] += 1
            if (-n, other) < (best[1], best[2]):
                best[1], best[2] = -n, other

    sides = [_Side(c, backwards, m) for c in chunks]
    left, right = sides[0], sides[-1]
    for i, j in replaced(left.acceptors[0], right.acceptors[0]):
        link(left.words[0][i], right.words[0][j])
    for x, y in ((left, right), (right, left))[:len(sides)]:
        for i, j in inserted(x.acceptors[0], y.acceptors[1]):
            link(x.words[0][i], y.words[1][j])
    for word, (count, n, other) in found.items():
        yield word, count, -n, other


def _near_in_groups(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (backwards, m, half, a, b, own, word, n), a group's next to each other."""
    key, members = None, {}
    for *at, own, word, n in rows:
        if at != key:
            if key:
                yield from _finish(key, members)
            key, members = at, {}
        members.setdefault(own, []).append((word, n))
    if key:
        yield from _finish(key, members)


def _finish(key: list, members: dict[int, list]) -> Iterator[tuple]:
    backwards, m, _, a, b = key
    chunks = [members.get(k, []) for k in ((a,) if a == b else (a, b))]
    if all(chunks) and sum(map(len, chunks)) > 1:
        yield from _near_in_group(chunks, bool(backwards), m)


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near word; input (word, n), each word once."""
    length = F.char_length("word")
    group = [F.array(*[F.struct(F.lit(back).alias("back"), m.alias("m"), half.alias("half")) for back, half in (
        (0, F.substring("word", F.lit(1), (m / 2).cast("int"))),
        (1, F.expr(f"right(word, length(word) - {drop} - (length(word) - {drop}) DIV 2)")))]) for drop, m in ((0, length), (1, length - 1))]
    keyed = words.select("word", "n", F.explode(F.concat(*group)).alias("at")).select("at.*", "word", "n").where(F.col("m") >= least_length)
    keyed = materialize(keyed, "variant-groups")
    at = ["back", "m", "half"]
    # Groups of one word, or without a word of the shorter length, have no pair.
    sizes = keyed.groupBy(*at).agg(F.count(F.lit(1)).alias("size"), F.min(F.char_length("word")).alias("shortest")) \
        .where((F.col("size") > 1) & (F.col("shortest") == F.col("m"))) \
        .select(*at, F.ceil(F.col("size") / group_words).cast("int").alias("chunks"))
    own = F.when(F.col("chunks") > 1, F.pmod(F.xxhash64(F.lit("chunk"), "word"), F.col("chunks")).cast("int")).otherwise(0)
    dealt = keyed.join(sizes, at).withColumn("own", own) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")})
    key = [*at, "a", "b"]
    wide = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = dealt.select(*key, "own", "word", "n").repartition(2 * wide, *key).sortWithinPartitions(*key)
    found = map_stream(placed, placed.columns, "word string, n_near long, best_n long, best string", _near_in_groups)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best) \
        .select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def roots_of(links: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last; input (word, form), without circles.

    Every round doubles the steps taken, so a chain of k forms needs log2(k)
    rounds; as a form is ``FORM_FACTOR`` times as frequent as its word, k is at most
    the logarithm of the largest count to that base.
    """
    reached = materialize(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variant-roots")
        reached = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      form_factor: int = FORM_FACTOR, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of the vocabulary.

    ``form`` is the most frequent near word (ties: the first in code-point order)
    if it occurs at least ``form_factor`` times as often, else null; ``root`` is
    reached by following forms, the word itself if it has none.  Null and empty
    texts have no words; repeated rows count each time; a row without an id
    counts with its words as written.  Other columns are ignored; an empty table
    gives an empty one.
    """
    words = materialize(vocabulary(docs, id_col, text_col, least_length, least_count), "variant-words")
    near = near_words(words, least_length, group_words)
    is_form = F.col("best_n") >= F.lit(form_factor) * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variant-forms")
    roots = roots_of(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
