"""Spelling variants: near words found by search schemes over suffix-rank intervals, and the form each one goes by.

Two words are near if one inserted, deleted or replaced character parts them. Such a pair shares the first or the last
half of either word, so two searches find all near words of a word: its left half is matched exactly and
extended to the right allowing one error, and its right half exactly and extended to the left. The second leaves
out words that hold the left half as well, so no near word is found twice.

The vocabulary is dealt into blocks by its halves, and a block's words stand one after another, each with its
delimiter, in an FM-index: one of the words as they are, which is read from right to left, or one of the reversed words,
which is read the other way. A state of a search is an interval of suffix ranks; one more character
narrows it by two rank look-ups. All searches of a block go on together, as vectors. A half that very many
words share is dealt over several blocks, and a word asks each of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from sluice.llm import files

LETTERS = "[A-Za-zÀ-ÿ]"
LEAST_CHARS = 7
LEAST_COUNT = 2
TIMES = 10  # a form occurs at least so many times as often
ONE_IN = 31  # of the runs, by a hash of document and run, loses a character
BLOCK_ROWS = 20_000  # of an index, at most about so many words
ASKED = 8192  # words searched together


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """(word, n): runs of letters of all texts, lower-cased in A-Z, with at least so many characters and occurrences.

    A run whose hash with its doc_id is divisible by ``one_in`` has lost one character. Null and empty texts have no
    words; a null doc_id is hashed as nothing. Rows count each, repeated ones too. Other columns are not read.
    """
    found = F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(f"({LETTERS}{{{least_chars},}})"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    low = runs.select("id", _lower(F.col("run")).alias("low"))
    hashed = low.select("low", F.crc32(F.concat("id", F.lit(":"), "low")).alias("h"))
    at = (F.col("h") % F.length("low")).cast("int")
    cut = F.concat(F.substr("low", F.lit(1), at), F.substr("low", at + 2))
    words = hashed.select(F.when(F.col("h") % one_in == 0, cut).otherwise(F.col("low")).alias("word"))
    return words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Index:
    """An FM-index of distinct words: suffix ranks of all words, each with a delimiter of its own, and their last column.

    Delimiters come before all characters, in the order of the words. The character before the suffix of rank r
    is ``last[r]``, 0 where the suffix is a whole word. The suffixes that begin with c and go on as those of
    ranks low to high - 1 have the ranks step(c, low) to step(c, high) - 1.
    """

    def __init__(self, words: list[str]):
        self.words = words
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.letters = np.unique(codes)
        self.size = len(codes) + len(words)  # with delimiters
        ends = np.cumsum(sizes + 1) - 1  # places of the delimiters
        text = np.zeros(self.size, dtype=np.int64)
        inside = np.ones(self.size, dtype=bool)
        inside[ends] = False
        text[inside] = np.searchsorted(self.letters, codes) + 1
        rank = self._ranks(text, ends, int(sizes.max(initial=0)))
        self.start = np.empty(self.size, dtype=np.int64)  # where the suffix of each rank begins
        self.start[rank] = np.arange(self.size)
        firsts = np.zeros(self.size, dtype=bool)
        firsts[ends - sizes] = True
        before = np.where(firsts, 0, np.concatenate(([0], text[:-1])))
        self.last = before[self.start]
        self.places = np.sort(self.last * (self.size + 1) + np.arange(self.size))
        self.ends = ends

    def _ranks(self, text: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """Ranks of all suffixes, from ranks of their first characters by doubling: each ends at its own delimiter."""
        rank = text + len(ends) - 1
        rank[ends] = np.arange(len(ends))
        known = 1
        while True:
            following = np.concatenate((rank[known:], np.zeros(min(known, len(rank)), dtype=np.int64)))
            key = rank * (self.size + len(self.letters) + 1) + following
            order = np.argsort(key, kind="stable")
            steps = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0))) if len(key) else key
            # a suffix that ends within the known characters has a rank of its own already
            rank = np.empty(self.size, dtype=np.int64)
            rank[order] = steps
            known *= 2
            if known > longest:
                return rank

    def step(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.places, code * (self.size + 1) + at)

    def found(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which intervals hold a whole word, and the number of that word."""
        first = self.step(np.zeros_like(low), low)
        whole = np.flatnonzero(first < self.step(np.zeros_like(low), high))
        return whole, np.searchsorted(self.ends, self.start[self.places[first[whole]]])

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All steps from the intervals: (interval, code, low, high).

        The characters before few suffixes are read off; where there are more suffixes than characters, each is tried.
        """
        wide = high - low > len(self.letters)
        few = np.flatnonzero(~wide)
        counts = (high - low)[few]
        of = np.repeat(few, counts)
        at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + low[of]
        pairs = np.unique(of * (len(self.letters) + 1) + self.last[at])
        all_of = np.repeat(np.flatnonzero(wide), len(self.letters))
        of = np.concatenate((pairs // (len(self.letters) + 1), all_of))
        code = np.concatenate((pairs % (len(self.letters) + 1), np.tile(np.arange(1, len(self.letters) + 1), int(wide.sum()))))
        of, code = of[code > 0], code[code > 0]
        new_low, new_high = self.step(code, low[of]), self.step(code, high[of])
        some = new_low < new_high
        return of[some], code[some], new_low[some], new_high[some]

    def search(self, asked: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked, found): the words one error from each asked one whose error lies before its last ``exact`` characters.

        Asked words are read from their ends: the exact characters first, then the rest with one error. Errors
        that give the same word are told apart: a character is deleted from a run at the run's end, inserted after it.
        """
        sizes = np.fromiter(map(len, asked), np.int64, len(asked))
        raw = np.frombuffer("".join(asked).encode("utf-32-le"), "<u4")
        place = np.searchsorted(self.letters, raw)
        known = (place < len(self.letters)) & (self.letters[np.minimum(place, max(len(self.letters) - 1, 0))] == raw) if len(self.letters) else np.zeros(len(raw), dtype=bool)
        codes = np.where(known, place + 1, len(self.letters) + 1)  # one beyond all for characters that no word has
        ends = np.cumsum(sizes)

        def code(q: np.ndarray, t: np.ndarray) -> np.ndarray:
            """The character of a word after t have been read."""
            return codes[ends[q] - 1 - t]

        q = np.arange(len(asked))
        low, high = np.zeros(len(q), dtype=np.int64), np.full(len(q), len(self.words), dtype=np.int64)
        t = 0
        none = np.empty(0, dtype=np.int64)
        one = (none, none, none, none)  # states with their error behind them: word, read, low, high
        out: list[tuple[np.ndarray, np.ndarray]] = []
        while len(q) or len(one[0]):
            if len(one[0]):
                of, read, a, b = one
                done = read == sizes[of]
                if done.any():
                    whole, word = self.found(a[done], b[done])
                    out.append((of[done][whole], word))
                    of, read, a, b = of[~done], read[~done], a[~done], b[~done]
                c = code(of, read)
                a, b = self.step(c, a), self.step(c, b)
                some = a < b
                one = (of[some], read[some] + 1, a[some], b[some])
            if not len(q):
                continue
            free = np.flatnonzero(t >= exact[q])  # past the exact half
            more = t < sizes[q]
            if len(free):
                at, c, a, b = self.branches(low[free], high[free])
                at = free[at]
                other = ~more[at] | (c != code(q[at], np.minimum(t, sizes[q[at]] - 1)))
                replaced = more[at] & other
                deleted = free[more[free]]
                here = code(q[deleted], np.full(len(deleted), t))
                final = t + 1 == sizes[q[deleted]]
                deleted = deleted[final | (here != code(q[deleted], np.minimum(t + 1, sizes[q[deleted]] - 1)))]
                new = [
                    (q[at[replaced]], np.full(int(replaced.sum()), t + 1), a[replaced], b[replaced]),
                    (q[at[other]], np.full(int(other.sum()), t), a[other], b[other]),
                    (q[deleted], np.full(len(deleted), t + 1), low[deleted], high[deleted]),
                ]
                one = tuple(np.concatenate(parts) for parts in zip(one, *new))
            q, low, high = q[more], low[more], high[more]
            c = code(q, np.full(len(q), t))
            low, high = self.step(c, low), self.step(c, high)
            some = low < high
            q, low, high = q[some], low[some], high[some]
            t += 1
        if not out:
            return none, none
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


LEFT, RIGHT = 0, 1  # which half is matched exactly


def _half(word: Column, size: Column, side: int) -> Column:
    """The left half of a word of ``size`` characters has size // 2 of them, the right half the others."""
    left = F.floor(size / 2).cast("int")
    return F.substr(word, F.lit(1), left) if side == LEFT else F.substr(word, F.length(word) - (size - left) + 1)


def dealt(words: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, side, asked, word, n): what each block indexes (asked 0) and is asked (asked 1).

    A word asks by its own halves and is indexed by the halves that words of its length, one less and one more would ask by.
    Halves go to blocks by their hash; a half with more than ``block_rows`` words has blocks of its own, which share
    its words, and all of which are asked.
    """
    size = F.length("word")
    entries = []
    for side in (LEFT, RIGHT):
        keys = F.array_distinct(F.array(*(_half(F.col("word"), size + d, side) for d in (-1, 0, 1))))
        entries.append(words.select(F.lit(side).alias("side"), F.lit(0).alias("asked"), "word", "n", F.explode(keys).alias("half")))
        entries.append(words.select(F.lit(side).alias("side"), F.lit(1).alias("asked"), "word", "n", _half(F.col("word"), size, side).alias("half")))
    every = entries[0].unionByName(entries[1]).unionByName(entries[2]).unionByName(entries[3])
    sizes = every.where("asked = 0").groupBy("side", "half").agg(F.count("*").alias("m"))
    blocks = -(-4 * words.count() // block_rows) or 1
    hot = sizes.where(F.col("m") > block_rows).select("side", "half", F.ceil(F.col("m") / block_rows).cast("int").alias("parts"))
    placed = every.join(hot, ["side", "half"], "left")
    own = F.when(F.col("asked") == 1, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("word", "side"), F.col("parts")).cast("int")))
    usual = F.concat_ws(":", "side", F.pmod(F.xxhash64("half"), F.lit(blocks)))
    parts = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).otherwise(own)
    spread = placed.select("side", "asked", "word", "n", "half", F.explode(parts).alias("part"))
    block = F.when(F.col("part") < 0, F.col("usual")).otherwise(F.concat_ws(":", "side", "half", "part"))
    return spread.withColumn("usual", usual).select(block.alias("block"), "side", "asked", "word", "n")


def _searched(words: DataFrame, kind: str, give, block_rows: int) -> DataFrame:
    names = [f.split()[0] for f in kind.split(", ")]
    kinds = [pa.string() if f.split()[1] == "string" else pa.int64() for f in kind.split(", ")]
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = dealt(words, block_rows).repartition(tasks, "block").sortWithinPartitions("block", "asked", "word")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in ("block", "side", "asked", "word", "n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, side), group in groupby(rows(batches), lambda r: r[:2]):
            held: dict[str, int] = {}
            index, asked = None, []

            def ask():
                made = give(index, held, asked, side)
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, kinds)], names=names)

            for _, _, question, word, n in group:
                if not question:
                    held[word] = n
                    continue
                if index is None:
                    index = Index([w[::-1] for w in held] if side == LEFT else list(held))
                asked.append((word, n))
                if len(asked) == ASKED:
                    yield ask()
                    asked = []
            if asked:
                yield ask()

    return table.mapInArrow(run, kind)


def _found(index: Index, held: dict[str, int], asked: list[tuple[str, int]], side: int) -> tuple[np.ndarray, np.ndarray]:
    """(asked, found) by number, each near word once over both sides."""
    words = [w[::-1] if side == LEFT else w for w, _ in asked]
    halves = np.fromiter((len(w) // 2 if side == LEFT else len(w) - len(w) // 2 for w in words), np.int64, len(words))
    of, found = index.search(words, halves)
    if side == RIGHT:
        names = list(held)
        rest = [k for k, (a, b) in enumerate(zip(of.tolist(), found.tolist())) if not names[b].startswith(words[a][: len(words[a]) // 2])]
        of, found = of[rest], found[rest]
    return of, found


def near_words(words: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(word, n, near, near_n): every pair of near words of (word, n), in both directions. Words are distinct and not null."""

    def give(index, held, asked, side):
        of, found = _found(index, held, asked, side)
        names, counts = list(held), list(held.values())
        pairs = [(*asked[a], names[b], counts[b]) for a, b in zip(of.tolist(), found.tolist())]
        return list(zip(*pairs)) or [[]] * 4

    return _searched(words, "word string, n long, near string, near_n long", give, block_rows)


def _best(words: DataFrame, block_rows: int) -> DataFrame:
    """(word, near_words, near, near_n) by block: how many near words a block holds, and the most frequent, of equals the least."""

    def give(index, held, asked, side):
        of, found = _found(index, held, asked, side)
        names, counts = list(held), np.fromiter(held.values(), np.int64, len(held))
        by_name = np.empty(len(names), dtype=np.int64)
        by_name[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        order = np.lexsort((by_name[found], -counts[found], of))
        first, many = np.unique(of[order], return_index=True)[1], np.bincount(of, minlength=len(asked))
        best, of = found[order][first], of[order][first]
        return [asked[a][0] for a in of.tolist()], many[of], [names[b] for b in best.tolist()], counts[best]

    return _searched(words, "word string, near_words long, near string, near_n long", give, block_rows)


def variants(words: DataFrame, times: int = TIMES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per word of (word, n): word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest n, of equals the least, if it has at least ``times`` the word's n, else null.
    ``root`` is reached by following forms; a word without a form is its own. As n grows with every step there is
    no circle, and paths shrink by doubling until all have ended.
    """
    words = files.written(words.select("word", "n"), "words")
    least = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))
    near = _best(words, block_rows).groupBy("word").agg(F.sum("near_words").alias("n_near"), F.array_min(F.collect_list(least)).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = files.written(formed, "forms")
    paths = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = files.written(paths.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        paths = steps.select("word", "root")
        if steps.where("moved").isEmpty():
            break
    return formed.join(paths, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
