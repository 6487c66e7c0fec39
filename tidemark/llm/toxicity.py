"""Toxicity by boosted trees over a few dense features, calibrated by isotonic regression.

The features are densities of learned lexicons (whole words, beginnings of words, words with
their disguise taken off), how often such words stand near a second person, and rates of
capitals, punctuation and disguise. A lexicon holds terms that labelled toxic documents use
far more often than clean ones. Labelled rows are in four folds: a row's features come from a
lexicon that has not seen its fold, and the calibration from trees that have not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees
from tidemark.llm.bytewords import Piece, ascii_lower, byte_set, crc32, pieces, words
from tidemark.llm.common import stored
from tidemark.llm.near_dup import mixed

SAMPLE_A_CLASS = 4000  # labelled rows the model is fitted on, at most, per class
LEXICON = 8192  # terms of a lexicon, at most: those of greatest evidence
EVIDENCE = 20.0  # least log-likelihood ratio of a term
LEAST_WEIGHT = 2.0  # least log ratio of a term's shares in the two classes
SHINGLE = 5  # words of the runs that tell copies apart from other documents
FOLDS = 4
NEAR = 3  # words between a term and a second person, at most
# Words for a second person in the languages of the corpus.
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "yourselves", "ur",
    "du", "dich", "dir", "dein", "deine", "deinen", "ihr", "euch", "euer", "eure",
    "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos",
    "ti", "tus", "tuyo", "usted", "ustedes", "vosotros", "vuestro",
)
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
TOKEN = ~byte_set((0x00, 0x20), (0x22, 0x22), (0x28, 0x29), (0x2C, 0x2C), (0x2F, 0x2F), (0x3A, 0x3B))
UPPER = byte_set((0x41, 0x5A))
SIGNS = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
LOWER = ascii_lower()


def _undisguised() -> np.ndarray:
    """Lower case, and the letter that a digit or sign stands for; 0 where there is none."""
    table = np.where(LETTERS, LOWER, 0).astype(np.uint8)
    # Digits and signs used in place of letters.
    for sign, letter in zip("013457@$!|", "oieastasii"):
        table[ord(sign)] = ord(letter)
    return table


PLAIN_LETTER = _undisguised()
# Where kinds tell the same in the labelled rows, trees take the first: it sees through disguise.
BARE, WHOLE, HEAD4, HEAD5 = range(4)
KINDS = 4
HEADS = {HEAD4: 4, HEAD5: 5}
# Sums over a document, by column, and then the largest weights.
(
    N_WORDS, HITS, WEIGHT, NEAR_HITS, PERSONS, CAPITALS, N_LETTERS, SHOUTED, BANGS, QUERIES,
    RUNS, N_SIGNS, N_BYTES, DISGUISED, N_TOKENS, HIDDEN, STRETCHED, SUMS,
) = (0, 1, 5, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23)
RAW = SUMS + KINDS


@dataclass
class Lexicon:
    """Sorted keys kind << 32 | hash with their weights, and a table that most others fail."""

    keys: np.ndarray
    weights: np.ndarray

    def __post_init__(self):
        self.likely = np.zeros((KINDS, 1 << 16), bool)
        self.likely[(self.keys >> np.uint64(32)).astype(int), (self.keys & np.uint64(0xFFFF)).astype(int)] = True

    def find(self, kind: int, hashed: np.ndarray) -> np.ndarray:
        """The weight of each term, 0 where it is none."""
        out = np.zeros(len(hashed))
        maybe = np.flatnonzero(self.likely[kind][hashed & np.uint32(0xFFFF)])
        if len(maybe):
            wanted = np.uint64(kind << 32) | hashed[maybe].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            out[maybe] = np.where(self.keys[at] == wanted, self.weights[at], 0)
        return out


@dataclass
class Terms:
    """The terms of a piece: row and hash by kind, and where words and tokens lie."""

    row: dict[int, np.ndarray]
    hashed: dict[int, np.ndarray]
    start: np.ndarray
    length: np.ndarray
    token_start: np.ndarray
    token_length: np.ndarray
    token_row: np.ndarray
    whole_of_token: np.ndarray  # the hash of the token's first word, where it has only one


def _terms(piece: Piece) -> Terms:
    row, start, length = words(piece, LETTERS)
    token_row, token_start, token_length = words(piece, TOKEN)
    if piece.goes_on:
        row, start, length = row[1:], start[1:], length[1:]
        token_row, token_start, token_length = token_row[1:], token_start[1:], token_length[1:]
    low = LOWER[piece.data]
    rows, hashed = {WHOLE: row}, {WHOLE: crc32(low, start, length)}
    for kind, size in HEADS.items():
        longer = length > size
        rows[kind] = row[longer]
        hashed[kind] = crc32(low, start[longer], np.full(int(longer.sum()), size))
    letters = PLAIN_LETTER[piece.data]
    kept = np.r_[0, np.cumsum(letters != 0)]
    begin, end = kept[token_start], kept[token_start + token_length]
    some = end > begin
    rows[BARE] = token_row[some]
    hashed[BARE] = crc32(letters[letters != 0], begin[some], (end - begin)[some])
    return Terms(rows, hashed, start, length, token_start, token_length, token_row, some)


def _spread(found: np.ndarray, row: np.ndarray, reach: int) -> np.ndarray:
    """Whether one of the places up to ``reach`` away in the same row is found."""
    out = found.copy()
    for step in range(1, reach + 1):
        same = row[step:] == row[:-step]
        out[step:] |= found[:-step] & same
        out[:-step] |= found[step:] & same
    return out


PERSON_HASHES = np.array([zlib.crc32(w.encode()) for w in SECOND_PERSON], np.uint32)


def _raw(piece: Piece, lexicon: Lexicon) -> np.ndarray:
    """Sums and largest weights of the rows of a piece."""
    terms, data, rows = _terms(piece), piece.data, piece.last - piece.first
    out = np.zeros((rows, RAW))

    def add(column: int, row: np.ndarray, value: np.ndarray | None = None) -> None:
        out[:, column] += np.bincount(row, value, rows)

    row = terms.row[WHOLE]
    add(N_WORDS, row)
    marked = np.zeros(len(row), bool)
    for kind in range(KINDS):
        weight = lexicon.find(kind, terms.hashed[kind])
        hit = weight > 0
        at = terms.row[kind]
        add(HITS + kind, at[hit])
        add(WEIGHT + kind, at, weight)
        np.maximum.at(out[:, SUMS + kind], at[hit], weight[hit])
        if kind == WHOLE:
            marked |= hit
        elif kind in HEADS:
            marked[np.flatnonzero(terms.length > HEADS[kind])[hit]] = True
        else:
            hidden = hit
    person = np.isin(terms.hashed[WHOLE], PERSON_HASHES)
    add(PERSONS, row[person])
    add(NEAR_HITS, row[marked & _spread(person, row, NEAR)])

    # Bytes, counted by row over the words and tokens they lie in.
    def inside(table: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(table)]
        return total[start + length] - total[start]

    upper = inside(UPPER[data], terms.start, terms.length)
    add(CAPITALS, row, upper)
    add(N_LETTERS, row, terms.length)
    add(SHOUTED, row[(upper == terms.length) & (terms.length > 2)])
    again = np.r_[False, data[1:] == data[:-1]]
    third = again & np.r_[False, again[:-1]] & LETTERS[data] & (data < 0x80)
    add(STRETCHED, row[inside(third, terms.start, terms.length) > 0])
    first = 0
    if piece.goes_on:  # the carried word has been counted
        first = int(terms.token_start[0]) if len(terms.token_start) else len(data)
    place = np.flatnonzero(SIGNS[data])
    place = place[place >= first]
    sign_row = np.searchsorted(piece.bounds, place, "right") - 1
    sign = data[place]
    add(N_SIGNS, sign_row)
    add(BANGS, sign_row[sign == ord("!")])
    add(QUERIES, sign_row[sign == ord("?")])
    add(RUNS, sign_row[again[place] & ((sign == ord("!")) | (sign == ord("?")))])
    out[:, N_BYTES] += np.diff(piece.bounds) - (first if piece.goes_on else 0)
    # A disguise: a letter on either side of something that is none.
    start, length = terms.token_start, terms.token_length
    letter = LETTERS[data]
    step = np.r_[False, letter[1:] & ~letter[:-1]]
    breaks = inside(step, start, length) - step[np.minimum(start, max(len(data) - 1, 0))] if len(data) else length
    disguised = (breaks > 0) & letter[start] if len(start) else np.zeros(0, bool)
    add(N_TOKENS, terms.token_row)
    add(DISGUISED, terms.token_row[disguised])
    bare_disguised = disguised[terms.whole_of_token]
    add(HIDDEN, terms.row[BARE][hidden & bare_disguised])
    return out


def _features(raw: np.ndarray) -> np.ndarray:
    """Densities and rates from sums."""
    n, letters = np.maximum(raw[:, N_WORDS], 1), np.maximum(raw[:, N_LETTERS], 1)
    tokens, size = np.maximum(raw[:, N_TOKENS], 1), np.maximum(raw[:, N_BYTES], 1)
    hits = raw[:, HITS : HITS + KINDS]
    columns = [
        *(100 * hits / n[:, None]).T,
        *np.log1p(hits).T,
        *(100 * raw[:, WEIGHT : WEIGHT + KINDS] / n[:, None]).T,
        *raw[:, SUMS:].T,
        np.log1p(raw[:, NEAR_HITS]),
        100 * raw[:, PERSONS] / n,
        raw[:, CAPITALS] / letters,
        raw[:, SHOUTED] / n,
        raw[:, BANGS] / size,
        raw[:, QUERIES] / size,
        raw[:, RUNS] / size,
        raw[:, N_SIGNS] / size,
        raw[:, DISGUISED] / tokens,
        np.log1p(raw[:, HIDDEN]),
        raw[:, STRETCHED] / n,
        np.log1p(raw[:, N_WORDS]),
    ]
    return np.stack(columns, axis=1)


def _whole_rows(texts: pa.Array, lexicon: Lexicon) -> Iterator[tuple[int, int, np.ndarray]]:
    """First row, last row and features; the parts of a long text are summed up."""
    held = None
    for piece in pieces(texts, TOKEN):
        raw = _raw(piece, lexicon)
        if held is not None and held[0] == piece.first:
            largest = np.maximum(held[2][:, SUMS:], raw[:, SUMS:])
            raw = held[2] + raw
            raw[:, SUMS:] = largest
        elif held is not None:
            yield held[0], held[1], _features(held[2])
        held = piece.first, piece.last, raw
    if held is not None:
        yield held[0], held[1], _features(held[2])


# -- fitting -------------------------------------------------------------------------------


def held_out() -> Column:
    """Rows whose label is never learned; a null doc_id is none of them."""
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return F.coalesce(remainder == 0, F.lit(False))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, class and fold, documents with it), summed up by batch."""
    for batch in batches:
        group = 2 * batch.column("fold").to_numpy() + batch.column("label").to_numpy()
        found = []
        for piece in pieces(batch.column("text"), TOKEN):
            terms = _terms(piece)
            for kind in range(KINDS):
                row = (terms.row[kind] + piece.first).astype(np.uint64)
                found.append(row << np.uint64(40) | np.uint64(kind << 32) | terms.hashed[kind].astype(np.uint64))
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        term = keys & np.uint64((1 << 40) - 1)
        code = term << np.uint64(4) | group[(keys >> np.uint64(40)).astype(np.int64)].astype(np.uint64)
        code, n = np.unique(code, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((code >> np.uint64(4)).astype(np.int64)),
                pa.array((code & np.uint64(15)).astype(np.int64)),
                pa.array(n.astype(np.int64)),
            ],
            ["term", "g", "n"],
        )


def evidence(a: np.ndarray, b: np.ndarray, toxic: float, clean: float) -> np.ndarray:
    """Log-likelihood ratio of a term in ``a`` of the toxic and ``b`` of the clean documents;
    0 for terms that clean documents use more."""

    def part(seen: np.ndarray, size: float, share: np.ndarray) -> np.ndarray:
        rest, own = size - seen, seen / size
        return seen * np.log(np.where(seen > 0, own / share, 1)) + rest * np.log(
            np.where(rest > 0, (1 - own) / np.maximum(1 - share, 1e-12), 1)
        )

    toxic, clean = max(toxic, 1.0), max(clean, 1.0)
    share = np.maximum((a + b) / (toxic + clean), 1e-12)
    ratio = 2 * (part(a, toxic, share) + part(b, clean, share))
    return np.where(a / toxic > b / clean, ratio, 0)


def _lexicon(terms: np.ndarray, a: np.ndarray, b: np.ndarray, toxic: float, clean: float) -> Lexicon:
    good = evidence(a, b, toxic, clean) >= EVIDENCE
    toxic, clean = max(toxic, 1.0), max(clean, 1.0)
    weight = np.log((a[good] + 0.5) / (toxic + 1)) - np.log((b[good] + 0.5) / (clean + 1))
    strong = weight > LEAST_WEIGHT
    keys = terms[good][strong]
    order = np.argsort(keys)
    if not len(order):
        return Lexicon(np.zeros(1, np.uint64), np.zeros(1))
    return Lexicon(keys[order], weight[strong][order])


@dataclass
class Model:
    lexicon: Lexicon | None
    trees: Trees | None
    curve: Isotonic | None
    fixed: float | None = None  # score of all documents where a class has no rows

    def scores(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self.curve(self.trees.margins(features)), 0, 1)


def _sample(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[int, int]]:
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
        .where(~held_out())
    )
    order = F.xxhash64("doc_id")
    picked = known.where("label = 1").orderBy(order, "doc_id").limit(most).unionAll(
        known.where("label = 0").orderBy(order, "doc_id").limit(most)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * most rows of two numbers: a broadcast of a known bound.
    rows = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    signed = rows.mapInArrow(_with_sign, "doc_id long, label int, text string, sign long")
    rows = stored(signed, "toxicity-labelled")
    # Copies would make any word that they share look like evidence: one of them is learned.
    single = rows.groupBy("label", "sign").agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    rows = rows.join(single, "doc_id", "left_semi")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS))
    all_of = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    return stored(rows.select("doc_id", "label", fold.alias("fold"), "text"), "toxicity-sample"), all_of


def _with_sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``sign``: the least hash of a row's runs of ``SHINGLE`` words, which near copies mostly
    share; a row of fewer words has a hash of them all."""
    none = np.iinfo(np.int64).max
    for batch in batches:
        sign, every = np.full(batch.num_rows, none), np.zeros(batch.num_rows, np.uint64)
        for piece in pieces(batch.column("text"), TOKEN):
            row, start, length = words(piece, TOKEN)
            row = piece.first + row
            hashed = mixed(crc32(piece.data, start, length).astype(np.uint64))
            np.add.at(every, row, hashed)
            if len(row) >= SHINGLE:
                run = hashed[: 1 - SHINGLE].copy()
                for step in range(1, SHINGLE):
                    run = mixed(run + hashed[step : len(hashed) - SHINGLE + 1 + step])
                whole = row[SHINGLE - 1 :] == row[: 1 - SHINGLE]
                np.minimum.at(sign, row[: 1 - SHINGLE][whole], (run[whole] >> np.uint64(1)).astype(np.int64))
        short = sign == none
        sign[short] = (every[short] >> np.uint64(1)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sign)], [*batch.schema.names, "sign"])


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_A_CLASS) -> Model:
    """Fits on at most ``most`` labelled rows of each class, those of smallest hash.

    Null labels count as none; where a document has several, their mean decides. Rows weigh
    as much as their class has labelled rows for each one of the sample.
    """
    sample, all_of = _sample(docs, labels, most)
    sizes = np.zeros((2, FOLDS))
    for r in sample.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r.label, r.fold] = r.n
    toxic, clean = sizes[1].sum(), sizes[0].sum()
    if not toxic or not clean:
        return Model(None, None, None, 1.0 if toxic else 0.0)
    counts = sample.select("label", "fold", "text").mapInArrow(_term_counts, "term long, g long, n long")
    columns = [F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"g{g}") for g in range(2 * FOLDS)]
    summed = counts.groupBy("term").agg(*columns)
    a, b = sum(F.col(f"g{2 * f + 1}") for f in range(FOLDS)), sum(F.col(f"g{2 * f}") for f in range(FOLDS))
    # Terms too rare for the evidence never pass it: 2 n log(all / toxic) is its greatest value.
    odds = (a / toxic) / ((b + 0.5) / clean)
    able = summed.where((a >= 3) & (odds > 2)).withColumn("strength", a * F.log(odds))
    top = able.orderBy(F.desc("strength"), "term").limit(LEXICON).collect()
    terms = np.array([r.term for r in top], np.uint64)
    by = np.array([[r[f"g{g}"] for g in range(2 * FOLDS)] for r in top], float).reshape(-1, 2 * FOLDS)
    a_by, b_by = by[:, 1::2], by[:, 0::2]
    whole = _lexicon(terms, a_by.sum(axis=1), b_by.sum(axis=1), toxic, clean)
    without = [
        _lexicon(
            terms, a_by.sum(axis=1) - a_by[:, f], b_by.sum(axis=1) - b_by[:, f],
            toxic - sizes[1, f], clean - sizes[0, f],
        )
        for f in range(FOLDS)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in range(FOLDS):
                part = batch.filter(pa.array(batch.column("fold").to_numpy() == f))
                for first, last, found in _whole_rows(part.column("text"), without[f]):
                    rows = part.slice(first, last - first)
                    yield pa.RecordBatch.from_arrays(
                        [rows.column("doc_id"), rows.column("label"), rows.column("fold"), pa.array([r.tobytes() for r in found], pa.binary())],
                        ["doc_id", "label", "fold", "features"],
                    )

    schema = "doc_id long, label int, fold long, features binary"
    found = sample.mapInArrow(run, schema).orderBy("doc_id").collect()
    x = np.stack([np.frombuffer(r.features) for r in found])
    y, fold = np.array([r.label for r in found], float), np.array([r.fold for r in found])
    share = {label: all_of[label] / max(1, int((y == label).sum())) for label in (0, 1)}
    weight = np.where(y == 1, share[1], share[0])
    weight /= weight.mean()
    unseen = np.zeros(len(y))
    for f in range(FOLDS):
        there = fold == f
        if there.any() and (~there).any():
            unseen[there] = fit_trees(x[~there], y[~there], weight[~there]).margins(x[there])
    return Model(whole, fit_trees(x, y, weight), fit_isotonic(unseen, y, weight))


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score reads the text alone, and the whole of it; null and empty texts have features
    of zero. Without labels of either class every score is 0.0, with one class its label. Rows
    that repeat a doc_id are scored each for itself. Other columns are not looked at. A text
    of more than a megabyte is read in parts; a second person and a term on both sides of a
    cut are not seen as near. The model's size is fixed by its parameters.
    """
    model = train(docs, labels)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, found in _whole_rows(batch.column("text"), model.lexicon):
                ids = batch.column("doc_id").slice(first, last - first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(model.scores(found))], ["doc_id", "score"])

    if model.fixed is not None:
        scored = text.select("doc_id", F.lit(model.fixed).alias("score"))
    else:
        scored = text.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
