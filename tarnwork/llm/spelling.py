"""Spelling variants: the vocabulary's acceptor composed with a one-edit transducer and the acceptor again."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, shuffle_width, table
from tarnwork.llm.registry import query
from tarnwork.session import settle

#: Code points of a run, after A-Z became a-z.
LETTER = "a-zÀ-ÿ"
#: A task hands its counts on when it holds this many words; the sums do not change.
HELD_WORDS = 400_000
#: States after which the shared register of suffixes is begun anew; more than one group's states may stand in it.
HELD_STATES = 1_000_000


def word_counts(df: DataFrame, least_length: int = 7, drop_one_in: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: runs of letters in lower case with at least ``least_length`` code points, and how often they occur.

    Where ``drop_one_in`` divides the checksum h of ``<id>:<run>``, the run loses its code point
    h modulo its length first (0: never), so that the counts hold slips. Counts are
    added up in the task before they are shuffled. NULL texts have no words, a NULL id reads as the empty text.
    """
    # Shorter runs cannot give a word; a longest run is taken whole, since the search goes on behind it.
    runs = re.compile(f"[{LETTER}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                found = Counter(runs.findall(text.as_buffer().to_pybytes().lower().decode()))
                if drop_one_in:
                    start = zlib.crc32(f"{key}:".encode())
                    for run, n in list(found.items()):
                        h = zlib.crc32(run.encode(), start)
                        if h % drop_one_in == 0:
                            at = h % len(run)
                            del found[run]
                            if len(run) > least_length:
                                held[run[:at] + run[at + 1 :]] += n
                held.update(found)
                if len(held) >= HELD_WORDS:
                    yield sent()
                    held.clear()
        if held:
            yield sent()

    rows = df.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("key"), col(text_col).alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Acceptors:
    """Minimal acyclic acceptors that share equal right languages: states are numbers, ``arcs[q]`` maps letters to states."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}

    def state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())  # letters come in order, as the words are sorted
        q = self.known.get(key)
        if q is None:
            q = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return q

    def accept(self, words: list[str]) -> int:
        """Initial state of the acceptor of distinct ``words`` in ascending order."""
        path: list[tuple[list[bool], dict[str, int]]] = [([False], {})]
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1][last[len(path) - 1]] = self.state(final[0], arcs)

        for word in words:
            same = 0
            for x, y in zip(word, last):  # noqa: B905
                if x != y:
                    break
                same += 1
            close(same)
            path += [([False], {}) for _ in range(len(word) - same)]
            path[-1][0][0] = True
            last = word
        close(0)
        return self.state(path[0][0][0], path[0][1])

    def common(self, p: int, q: int) -> Iterator[str]:
        """Words that are accepted from both states; past the edit both sides read the same."""
        todo = [(p, q, "")]
        while todo:
            p, q, read = todo.pop()
            if self.final[p] and self.final[q]:
                yield read
            if p == q:
                todo += [(t, t, read + c) for c, t in self.arcs[p].items()]
            else:
                other = self.arcs[q]
                todo += [(t, other[c], read + c) for c, t in self.arcs[p].items() if c in other]

    def replaced(self, root: int) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ by one replaced letter."""
        todo = [(root, "")]
        while todo:
            q, read = todo.pop()
            arcs = list(self.arcs[q].items())
            for i, (c, t) in enumerate(arcs):
                todo.append((t, read + c))
                for d, u in arcs[i + 1 :]:
                    for rest in self.common(t, u):
                        yield read + c + rest, read + d + rest

    def inserted(self, root: int, longer: int) -> Iterator[tuple[str, str, int]]:
        """``shorter, longer, place`` of words accepted from the two states, where the longer has one more letter at ``place``.

        Within a run of one letter there are several such places; all are given.
        """
        todo = [(root, longer, "")]
        while todo:
            p, q, read = todo.pop()
            ahead = self.arcs[p]
            for c, t in self.arcs[q].items():
                for rest in self.common(p, t):
                    yield read + rest, read + c + rest, len(read)
                if c in ahead:
                    todo.append((ahead[c], t, read + c))


def group_pairs(machine: Acceptors, words: list[str], m: int, a: int, b: int) -> Iterator[tuple[str, str]]:
    """Pairs of one edit at the places ``a`` to ``b - 1`` among words that share what lies left and right of them.

    Pairs of two words of ``m`` letters, and of one of ``m`` with one of ``m + 1``. An added letter
    counts at the last place of its run of equal letters, so each pair is given by one group only.
    """
    tail = m - min(b, m)
    inner = {len_: sorted(w[a : len_ - tail] for w in words if len(w) == len_) for len_ in (m, m + 1)}
    if not inner[m] or len(words) < 2:
        return
    left, right = words[0][:a], words[0][len(words[0]) - tail :]
    root = machine.accept(inner[m])
    for x, y in machine.replaced(root):
        yield left + x + right, left + y + right
    if inner[m + 1]:
        for x, y, at in machine.inserted(root, machine.accept(inner[m + 1])):
            x, y, at = left + x + right, left + y + right, a + at
            if at < b and (at == len(x) or x[at] != y[at]):
                yield x, y


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n_near, near_n, near`` of each word and group from rows sorted by group."""
    machine, key, group, out = Acceptors(), None, [], []

    def close() -> None:
        nonlocal machine
        if len(group) > 1:
            counts = {w: n for w, n, *_ in group}
            best: dict[str, tuple[int, int, str]] = {}
            for pair in group_pairs(machine, list(counts), *group[0][2:]):
                for one, other in (pair, pair[::-1]):
                    n = counts[other]
                    had = best.get(one)
                    if had is None:
                        best[one] = (1, n, other)
                    else:
                        best[one] = (had[0] + 1, *((n, other) if n > had[1] or n == had[1] and other < had[2] else had[1:]))
            out.extend((w, *found) for w, found in best.items())
            if len(machine.arcs) > HELD_STATES:
                machine = Acceptors()
        group.clear()

    def sent() -> pa.RecordBatch:
        names, kinds = ("word", "n_near", "near_n", "near"), (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("group", "word", "n", "m", "a", "b")], strict=True):
            if row[0] != key:
                close()
                key = row[0]
            group.append(row[1:])
        if len(out) >= 10_000:
            yield sent()
            out.clear()
    close()
    if out:
        yield sent()


def near_words(words: DataFrame, most: int = 2_000) -> DataFrame:
    """``word, n_near, near_n, near`` of distinct ``words`` (``word, n``) that have a word at one edit: how many, and the one of largest n.

    An edit of a word of m letters (the shorter one, if they differ) lies in one of the places 0 to m. Words are
    grouped by what lies outside a range of places, beginning with the two halves: all pairs whose
    edit lies in the range share their letters left and right of it, and stand in one group. Each group is an initial
    state of the composition, whose accepted pairs are enumerated in one task. Groups of more than ``most`` words are
    cut into half as wide ranges, down to one place, where a group can hold no more words than there are
    letters, and as many times as many of one letter more (8,190 for the 90 letters here). So nothing is left out and no
    group is large. Ties go to the smallest word. Rows of a NULL word and repeated words are not expected.
    """
    lengths = F.explode(F.array(F.length("word") - 1, F.length("word"))).alias("m")
    rows = words.select("word", "n", lengths).where("m > 0")

    def ranges(first: Column, end: Column) -> Column:
        middle = F.floor((first + end) / 2).cast("int")
        return F.explode(F.array(F.struct(first.alias("a"), middle.alias("b")), F.struct(middle.alias("a"), end.alias("b")))).alias("r")

    def grouped(cut: DataFrame) -> DataFrame:
        cut = cut.select("word", "n", "m", "r.a", "r.b", (F.col("m") - F.least("r.b", "m")).alias("tail")).where("a < b")
        shared = F.concat_ws(":", "m", "a", "b", F.expr("left(word, a)"), F.expr("right(word, tail)"))
        return cut.withColumn("group", shared)

    zero = F.lit(0)
    parts, todo = [], grouped(rows.select("word", "n", "m", ranges(zero, F.col("m") + 1)))
    while True:
        todo = settle(todo, "groups")
        large = todo.where("b - a > 1").groupBy(F.col("group").alias("large")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)
        large = settle(large, "large-groups")
        if not large.head(1):
            break
        small = todo.join(large, todo["group"] == large["large"], "left_anti")
        parts.append(small)
        again = todo.join(large, todo["group"] == large["large"], "left_semi")
        todo = grouped(again.select("word", "n", "m", ranges(F.col("a"), F.col("b"))))
    for part in parts:
        todo = todo.unionByName(part)
    width = shuffle_width(words.sparkSession)
    dealt = todo.select("group", "word", "n", "m", "a", "b").repartition(width, "group").sortWithinPartitions("group")
    found = dealt.mapInArrow(_near, "word string, n_near long, near_n long, near string")
    first = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("best")).select("word", "n_near", (-F.col("best.minus")).alias("near_n"), "best.near")


def spelling_variants(words: DataFrame, times: int = 10, most: int = 2_000) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct ``words`` with their counts ``n``.

    ``n_near`` counts the words at exactly one inserted, deleted or replaced code point. The form is the
    one of largest ``n`` (the smallest in code-point order among equals), if it occurs at least ``times`` as often;
    ``root`` is what the forms lead to in the end, the word itself without one. Counts grow
    along the forms, so they end, and doubling the steps finds the roots in a few joins.
    An empty table gives no rows; other columns are ignored.
    """
    if times < 2:
        raise ValueError("times must be at least 2, or forms could lead in a circle")
    words = settle(words.select("word", "n"), "vocabulary")
    near = near_words(words, most).withColumnRenamed("word", "of")
    formed = words.join(near, words["word"] == near["of"], "left")
    is_form = F.col("near_n") >= times * F.col("n")
    formed = formed.select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n")
    )
    formed = settle(formed, "forms")
    steps = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        ahead = steps.select(F.col("word").alias("from"), F.col("root").alias("to"))
        longer = steps.join(ahead, steps["root"] == ahead["from"], "left")
        steps = settle(longer.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        if not steps.where("moved").head(1):
            break
        steps = steps.select("word", "root")
    roots = steps.select(F.col("word").alias("of"), "root")
    return formed.join(roots, formed["word"] == roots["of"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")).where("n >= 2"))
