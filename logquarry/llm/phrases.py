"""Phrase collocation mining by Rabin-Karp fingerprints (operator 13).

Words are hashed from prefix sums of a polynomial over their bytes, phrases of n words from prefix sums of a
polynomial over the words' hashes, so a fingerprint of every phrase costs two array operations. Lengths are
counted one after the other: a task adds up equal fingerprints, a shuffle adds up the tasks' sums, and a
phrase is only looked at when both phrases of one word less within it are frequent. Which fingerprints are
frequent is kept in bit tables of bounded size.

Then the texts are read once more. Only occurrences that the tables let through are materialised: in each
slab equal fingerprints point at their first occurrence, every other is compared with it word by word, and
those that differ are counted as phrases of their own. What is shuffled is a phrase's text and count once for
a task, so the counts are those of texts, not of hashes. Scores, cuts and contained phrases are joins over the
table of frequent phrases.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logquarry.llm.common import _GOLDEN, _INVERSE, _POLY, _POWER, BYTE_VALUE, CHUNK_BYTES, bitmap, filter_bits, maybe_in, mixed, slabs, stored, utf8

WORDS = 5  # of the longest phrase
LEAST = 100  # occurrences of a candidate
COVERED = 100  # percent of a phrase's occurrences that lie in one longer phrase, from which on it is dropped
PER_LANGUAGE = 2_000
FEW_LANGUAGES = 10_000  # whose sums are broadcast; more are joined by shuffling
NO_LANGUAGE = "und"
_EXACT = "cast({} as decimal(17,0)) * cast({} as decimal(17,0))"  # 34 digits; with the factor 1000 no more than 38
SPARE_BITS = 8  # of a bit table: about 1 in 256 other fingerprints pass


def _byte_kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of words, bytes that end a piece, and bytes with A-Z as a-z."""
    ends = np.zeros(256, bool)
    ends[list(b".,;:!?\n\v\f\r")] = True
    word = ~ends
    word[list(b" \t")] = False
    lower = np.arange(256, dtype=np.uint8)
    lower[0x41:0x5B] += 32
    return word, ends, lower


WORD, PIECE_END, LOWER = _byte_kinds()


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, room) of each word of consecutive rows; ``room`` counts the words from it to its piece's end."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    inside = WORD[part]
    cut = np.zeros(hi - lo + 1, bool)
    cut[offsets - lo] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.searchsorted(offsets - lo, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(PIECE_END[part]), starts)
    new = np.ones(len(starts) + 1, bool)
    new[1:-1] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
    bounds = np.flatnonzero(new)
    room = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(starts))
    return starts + lo, ends + lo, row, room


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of words from prefix sums over chunks of bytes; a longer word is summed up chunk by chunk."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right"))
        if j > i:
            lo, hi = int(starts[i]), int(ends[j - 1])
            total = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(BYTE_VALUE[data[lo:hi]] * _POWER[: hi - lo], out=total[1:])
            out[i:j] = (total[ends[i:j] - lo] - total[starts[i:j] - lo]) * _INVERSE[starts[i:j] - lo]
            i = j
            continue
        value = 0
        for lo in range(int(starts[i]), int(ends[i]), CHUNK_BYTES):
            part = BYTE_VALUE[data[lo : min(lo + CHUNK_BYTES, int(ends[i]))]]
            value += int((part * _POWER[: len(part)]).sum()) * pow(_POLY, lo - int(starts[i]), 1 << 64)
        out[i] = value % (1 << 64)
        i += 1
    return mixed(out + (ends - starts).astype(np.uint64) * _GOLDEN)


def fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of each ``n`` consecutive words from prefix sums of a polynomial over their hashes."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    step = len(_POWER) - n
    for lo in range(0, len(out), step):
        hi = min(lo + step, len(out))
        part = hashes[lo : hi + n - 1]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _POWER[: len(part)], out=total[1:])
        out[lo:hi] = (total[n : n + hi - lo] - total[: hi - lo]) * _INVERSE[: hi - lo]
    return mixed(out + np.uint64(n * int(_GOLDEN) % 2**64))


def _language_hash(name: str) -> int:
    return int.from_bytes(blake2b(name.encode(), digest_size=8).digest(), "little")


class Slab:
    """Words of consecutive rows, and fingerprints of their phrases that also tell the rows' languages apart."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray):
        self.data = data
        self.starts, self.ends, self.row, self.room = spans(data, offsets)
        self.hashes = word_hashes(data, self.starts, self.ends)
        self.salt = languages[self.row]

    def keys(self, n: int) -> np.ndarray:
        found = fingerprints(self.hashes, n)
        return mixed(found ^ self.salt[: len(found)])

    def passing(self, n: int, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(place, key) of the phrases of ``n`` words whose shorter parts pass ``tables``, and they themselves if it has n."""
        on = np.ones(len(self.starts), bool)
        for size in range(1, n + 1):
            keys = self.keys(size)
            on = on[: len(keys)]
            if size > 1:
                on = on & following[: len(keys)]
            at = np.flatnonzero(on & (self.room[: len(keys)] >= size))
            if size <= len(tables):
                at = at[maybe_in(tables[size - 1], keys[at])]
            on = np.zeros(len(keys), bool)
            on[at] = True
            following = on[1:]
        return at, keys[at]


def _slabs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slab, list[str]]]:
    """Slabs of (lang, text) with the language of each row."""
    for batch in batches:
        names = batch.column(0).to_pylist()
        known = {name: _language_hash(name) for name in set(names)}
        data, bounds = utf8(batch.column(1))
        for first, last in slabs(bounds):
            part = names[first:last]
            yield Slab(data, bounds[first : last + 1], np.array([known[name] for name in part], np.uint64)), part


def _counted(batches: Iterator[pa.RecordBatch], n: int, tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (fp, n): how often each fingerprint of ``n`` words occurs in a slab."""
    for slab, _ in _slabs_of(batches):
        keys, often = np.unique(slab.passing(n, tables)[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(often.astype(np.int64))], names=["fp", "n"])


def _word_ids(slab: Slab) -> np.ndarray:
    """Numbers that are equal for words of equal text: by hash, each compared with the first of its hash byte by byte."""
    _, first, ids = np.unique(slab.hashes, return_index=True, return_inverse=True)
    size = slab.ends - slab.starts
    model = first[ids]
    odd = size != size[model]
    check = np.flatnonzero(~odd & (model != np.arange(len(ids))))
    upto = np.cumsum(size[check])
    lo = 0
    while lo < len(check):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + CHUNK_BYTES, "right")))
        some = check[lo:hi]
        inner = np.arange(size[some].sum()) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
        one = LOWER[slab.data[np.repeat(slab.starts[some], size[some]) + inner]]
        other = LOWER[slab.data[np.repeat(slab.starts[model[some]], size[some]) + inner]]
        odd[np.repeat(some, size[some])[one != other]] = True
        lo = hi
    if odd.any():  # words that share a hash: told apart by their text
        known: dict[bytes, int] = {}
        ids = ids.copy()
        for i in np.flatnonzero(odd).tolist():
            word = LOWER[slab.data[slab.starts[i] : slab.ends[i]]].tobytes()
            ids[i] = known.setdefault(word, len(first) + len(known))
    return ids


def _phrases(batches: Iterator[pa.RecordBatch], tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, words, phrase, n): the texts of phrases that pass all tables, and all words as phrase ''."""
    for slab, names in _slabs_of(batches):
        out: list[tuple[str, int, str, int]] = []
        per_row = np.bincount(slab.row, minlength=len(names))
        totals: dict[str, int] = {}
        for name, count in zip(names, per_row.tolist()):
            totals[name] = totals.get(name, 0) + count
        out.extend((name, 0, "", count) for name, count in totals.items())
        if len(slab.starts):
            ids = _word_ids(slab)
            low = LOWER[slab.data[slab.starts[0] : slab.ends[-1]]].tobytes()
            starts, ends = slab.starts - slab.starts[0], slab.ends - slab.starts[0]
        for n in range(1, len(tables) + 1):
            if not len(slab.starts):
                break
            at, keys = slab.passing(n, tables)
            _, first, group = np.unique(keys, return_index=True, return_inverse=True)
            model = at[first][group]
            odd = slab.salt[at] != slab.salt[model]
            for k in range(n):
                odd |= ids[at + k] != ids[model + k]
            often = np.bincount(group[~odd], minlength=len(first))
            places, counts = at[first].tolist(), often.tolist()
            if odd.any():  # phrases that share a fingerprint
                apart: dict[tuple, list[int]] = {}
                for i in at[odd].tolist():
                    apart.setdefault((int(slab.salt[i]), *ids[i : i + n].tolist()), []).append(i)
                places, counts = places + [v[0] for v in apart.values()], counts + [len(v) for v in apart.values()]
            rows = slab.row[places].tolist() if places else []
            a, b = [starts[np.array(places, np.int64) + k].tolist() for k in range(n)], [ends[np.array(places, np.int64) + k].tolist() for k in range(n)]
            for i, (row, count) in enumerate(zip(rows, counts)):
                phrase = b" ".join([low[a[k][i] : b[k][i]] for k in range(n)])
                out.append((names[row], n, phrase.decode(), count))
        types = (pa.string(), pa.int32(), pa.string(), pa.int64())
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])


def phrase_counts(docs: DataFrame, lang_column: str, text_column: str, words: int, least: int) -> DataFrame:
    """(lang, words, phrase, n): exact counts of all phrases of 1 to ``words`` words that occur ``least`` times or more in a language.

    Phrase '' of 0 words holds the number of all words.
    """
    lang = F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    source = docs.select(lang, F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    sc = docs.sparkSession.sparkContext
    tables: list = []
    for size in range(1, words + 1):

        def count(batches, size=size, known=tuple(tables)):
            return _counted(batches, size, [t.value for t in known])

        sums = source.mapInArrow(count, "fp bigint, n bigint").groupBy("fp").agg(F.sum("n").alias("n"))
        frequent = stored(sums.where(F.col("n") >= least).select("fp"))
        tables.append(sc.broadcast(bitmap(frequent, "fp", filter_bits(frequent.count(), SPARE_BITS))))

    def materialise(batches):
        return _phrases(batches, [t.value for t in tables])

    found = source.mapInArrow(materialise, "lang string, words int, phrase string, n bigint")
    sums = found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return stored(sums.where((F.col("n") >= least) | (F.col("words") == 0)))


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    docs: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    words: int = WORDS,
    least: int = LEAST,
    covered: int = COVERED,
    per_language: int = PER_LANGUAGE,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases whose parts occur together most above chance.

    A phrase of 2 to ``words`` words that occurs a >= ``least`` times is cut where 1000 a n / (l r) is
    lowest, the earlier cut at a tie; n is the number of the language's words, l and r how often the cut's
    sides occur. A phrase inside a longer one that has ``covered`` percent of its occurrences is dropped. The
    first ``per_language`` by score, a (both falling) and the bytes of the phrase are returned.

    A null text is empty, a null language ``und``; words without text, texts without words and repeated
    rows count as they are. Other columns are ignored; no rows, no result.
    """
    counts = phrase_counts(docs, lang_column, text_column, words, least)
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    if totals.count() <= FEW_LANGUAGES:
        totals = F.broadcast(totals)  # a join by language alone would deal all phrases of one to one task
    candidates = counts.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    known = counts.where("words > 0")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    sides = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    sides = sides.join(known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(totals, "lang")
    # l and r are at least a, so the quotient is at most 1000 n
    score = F.expr(f"({_EXACT.format('a', 'total')} * 1000) div ({_EXACT.format('l', 'r')})")
    cut = F.struct(score.alias("score"), "k", "l", "r")
    scored = sides.groupBy("lang", "phrase", "a", "total").agg(F.min(cut).alias("cut"))
    inner = "transform(sequence(0, words - m), i -> array_join(slice(split(phrase, ' '), i + 1, m), ' '))"
    parts = F.explode(F.expr(f"flatten(transform(sequence(2, words - 1), m -> {inner}))"))
    around = candidates.where("words > 2").select("lang", parts.alias("phrase"), F.col("a").alias("longer"))
    around = stored(around.groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    whole = scored.join(around, ["lang", "phrase"], "left").where(F.coalesce(100 * _wide("longer") < covered * _wide("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")


def op13_collocations(spark, sf_dir) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
       unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
       FROM documents),
 w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
 total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
 sizes AS (SELECT lang, w, unnest(range(1, 6)) AS words FROM w),
 places AS (SELECT lang, w, words, unnest(range(1, len(w) - words + 2)) AS i FROM sizes),
 f AS (SELECT lang, words, phrase, count(*) AS f FROM (SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase FROM places)
       GROUP BY lang, words, phrase HAVING count(*) >= 100),
 c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS p FROM f WHERE words > 1),
 k AS (SELECT lang, words, phrase, a, p, unnest(range(1, words)) AS k FROM c),
 cuts AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r, total.n,
       CAST((CAST(1000 AS HUGEINT) * k.a * total.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
       FROM k JOIN f AS x ON x.lang = k.lang AND x.phrase = array_to_string(k.p[1:k.k], ' ')
       JOIN f AS y ON y.lang = k.lang AND y.phrase = array_to_string(k.p[k.k + 1:], ' ') JOIN total ON total.lang = k.lang),
 best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
 inner_sizes AS (SELECT lang, words, a, p, unnest(range(2, words)) AS m FROM c),
 inner_parts AS (SELECT lang, a, p, m, unnest(range(1, words - m + 2)) AS i FROM inner_sizes),
 inside AS (SELECT lang, array_to_string(p[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM inner_parts GROUP BY 1, 2),
 kept AS (SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
       WHERE inside.longer IS NULL OR 100 * inside.longer < 100 * best.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
