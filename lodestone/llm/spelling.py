"""Spelling variants: letter-parity masks in three bands find all words that are one edit apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.shared import ascii_lower, discard, staged

LETTER = "[A-Za-zÀ-ÿ]"
#: a-z by how frequent they are; dealt to the three bands in turn, so that each tells words apart about as well. Fixed value.
FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"
BANDS = 3


def band_tables() -> np.ndarray:
    """The bit of each letter in each band: a letter has one bit in one band."""
    table = np.zeros((BANDS, 257), np.int64)
    for letters in (FREQUENT, "".join(map(chr, range(0xC0, 0x100)))):
        for k, letter in enumerate(letters):
            band = k % BANDS
            table[band, ord(letter)] = 1 << np.count_nonzero(table[band])
    return table


def band_masks(words: list[str]) -> np.ndarray:
    """Of each word three bit masks: the letters it holds an odd number of times. Words are not empty and of letters of run_counts()."""
    signs = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    sizes = np.array([len(w) for w in words])
    bits = band_tables()[:, np.minimum(signs, 256)]
    if not bits.any(axis=0).all():
        raise ValueError("words hold signs other than a-z and U+00C0 to U+00FF")
    return np.bitwise_xor.reduceat(bits, np.cumsum(sizes) - sizes, axis=1)


def run_counts(docs: DataFrame, id_col: str, text_col: str, least_length: int, least_count: int, one_in: int) -> DataFrame:
    """word and n of the corpus: runs of letters, A-Z lower-cased, one in `one_in` of them misspelt by its hash."""
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"({LETTER}{{{least_length},}})"))).alias("run"),
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    words = runs.select("run", h.alias("h")).select(
        F.when(
            F.col("h") % one_in == 0,
            F.expr("concat(left(run, cast(h % length(run) as int)), substring(run, cast(h % length(run) as int) + 2))"),
        )
        .otherwise(F.col("run"))
        .alias("word")
    )
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _masked(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                masks = band_masks(batch.column("word").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), *map(pa.array, masks)], ["word", "n", "m0", "m1", "m2"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, m0 long, m1 long, m2 long")


def _keys(masked: DataFrame, longer: bool) -> DataFrame:
    """Rows of a word, one for each slot (band and side), under the key that words one edit apart share in one slot.

    base: the length of the shorter of the two words of a pair, the word's own
    or (longer) one less. The edit leaves the first or the last half of the
    shorter one, and one band of the mask, as they are; where lengths differ,
    one of the first two bands.
    """
    base = F.length("word") - int(longer)
    half = (base / 2).cast("int")
    sides = (F.substring("word", F.lit(1), half), F.substring("word", F.length("word") - (base - half) + 1, base - half))
    slots = [
        F.struct(F.lit(2 * k + s).alias("slot"), F.xxhash64(F.lit(2 * k + s), base, F.col(f"m{k}"), sides[s]).alias("key"))
        for k in range(BANDS - int(longer))
        for s in (0, 1)
    ]
    return masked.select("*", half.alias("half"), F.explode(F.array(*slots)).alias("at")).select("*", "at.slot", "at.key").drop("at")


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs a < b or b longer than a, of words (word, n) that differ by one inserted, deleted or replaced code point, each once.

    Columns: a, b, n_a, n_b. An inserted or deleted letter turns one bit of the
    mask, a replaced one two, so that of three bands one stays equal: words
    join where a band and the length fit. So that a crowded band splits, the
    key also holds the half that the edit left alone. Then the other bands may
    differ by no more bits than the edit turns, and the words themselves decide.
    A pair comes from its first equal band, by its first half if that is equal.
    """
    masked = staged(_masked(words), "masks")
    left = _keys(masked, False).select(*(F.col(c).alias(f"l_{c}") for c in ("word", "n", "m0", "m1", "m2")), "half", "slot", "key")

    def meet(longer: bool) -> DataFrame:
        right = _keys(masked, longer).select(*(F.col(c).alias(f"r_{c}") for c in ("word", "n", "m0", "m1", "m2")), F.col("slot").alias("r_slot"), F.col("key").alias("r_key"))
        turned = " + ".join(f"bit_count(l_m{k} ^ r_m{k})" for k in range(BANDS))
        pair = (
            (F.col("slot") == F.col("r_slot"))
            & (F.col("key") == F.col("r_key"))
            & F.expr(f"{turned} = {1 if longer else 2}")
            & F.expr("length(r_word) = length(l_word) + 1" if longer else "l_word < r_word and length(r_word) = length(l_word)")
            & F.expr("(slot < 2 or l_m0 <> r_m0) and (slot < 4 or l_m1 <> r_m1)")
            & F.expr("slot % 2 = 0 or left(l_word, half) <> left(r_word, half)")
            & F.expr("levenshtein(l_word, r_word, 1) = 1")
        )
        return left.join(right, pair).select(F.col("l_word").alias("a"), F.col("r_word").alias("b"), F.col("l_n").alias("n_a"), F.col("r_n").alias("n_b"))

    return meet(False).unionAll(meet(True))


def rooted(forms: DataFrame) -> DataFrame:
    """word and root of forms (word, form): the last word that forms lead to, by pointer doubling.

    n at least doubles with each form, so paths are short and have no cycle.
    """
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = staged(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(at)
        at = stepped.drop("moved")
        if stepped.where("moved").isEmpty():
            return at


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    ratio: int = 2,
    one_in: int = 97,
) -> DataFrame:
    """Group the words of a corpus with the more frequent words that they may be misspellings of.

    Words are runs of letters (A-Z, a-z and U+00C0 to U+00FF, only A-Z
    lower-cased) of at least `least_length` code points that occur at least
    `least_count` times; one run in `one_in`, by a hash of document and run,
    loses a letter first. A word's form is its most frequent near word (ties:
    smallest in code-point order), if that has at least `ratio` times its count;
    root follows the forms to the last.

    Columns: word, form, root, n, n_near, form_n.

    Defined results: null and empty texts have no words; a null id hashes as
    the empty string; texts of any length are read whole; repeated rows count
    each; a word without a near word has n_near 0, no form and itself as root;
    an empty table gives an empty table; other columns are ignored.
    """
    words = staged(run_counts(docs, id_col, text_col, least_length, least_count, one_in), "words")
    pairs = staged(near_pairs(words), "pairs")
    both = pairs.select(F.col("a").alias("word"), "n_a", "b", "n_b").unionAll(pairs.select("b", "n_b", "a", "n_a")).toDF("word", "n", "near", "near_n")
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
        F.max("n").alias("own"),
    )
    fits = -F.col("best.less") >= ratio * F.col("own")
    near = staged(
        best.select(
            "word", "n_near", F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
        ),
        "near",
    )
    roots = rooted(near.where("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
