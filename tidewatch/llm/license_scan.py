"""Licence scan: TF-IDF cosine with templates, then inheritance along directories.

*Own licence.* A file's units are its lines, its paragraphs (lines between blank ones) and the
whole text: a header is a line or a paragraph, a licence file a paragraph or all of it. Units and
templates are sparse vectors of words weighted count * (ln((1 + N) / (1 + df)) + 1), where df is the
number of files among all N that hold the word; words outside the templates weigh like one that
no file holds. The best cosine of LEAST or more names the licence. A template means only units that hold the words it
asks for and none that it excludes, which tells versions of a licence apart; a unit about as near to another licence names none.

*Inherited licence.* A file without its own takes that of the nearest ancestor directory that has
a licence file (by name, LICENCE_FILE). Each distinct directory is joined once with its
ancestors that hold one, by equality of paths; files then join their directory.

A file with null or empty text has no licence of its own. A null path has no directory and inherits
nothing. Several licence files in a directory: the best score counts, then the smaller path.
Equal cosines: the earlier template. Repeated rows are each reported. Result columns replace columns of the same name. An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .arrays import FOLD, WORD_OF_LETTERS, add_columns, hashed, map_slices, mixed, without, words
from .license_templates import TEMPLATES, Template

LEAST = 0.7
MARGIN = 0.01  # a unit that is about as near to another licence names none
EXACT = 0.9999
UNITS = 2048  # units compared at a time
FEW = 200_000  # directories whose licences are broadcast; more are joined piece by piece
LARGE = 32 << 20  # bytes of their paths and licences, beyond which fewer are joined piece by piece, too
PIECES = 16
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
FOUND = "own string, score double"


def _words(buf, at):
    low = FOLD[buf]
    starts, ends, row = words(low, at, WORD_OF_LETTERS)
    return starts, row, hashed(low, starts, ends)


def _of_texts(texts: list[str]):
    raw = [t.encode() for t in texts]
    return _words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    vocabulary: np.ndarray  # sorted word hashes of the templates
    idf: np.ndarray  # of the vocabulary
    other_idf: float
    matrix: np.ndarray  # vocabulary x templates, columns of length 1
    anchors: np.ndarray  # of the vocabulary: whether a unit with the word may be meant by a template
    ruled: np.ndarray  # place of each word that a template asks for or excludes among these, else -1
    must: np.ndarray  # templates x ruled words
    never: np.ndarray
    family: np.ndarray  # number of each template's licence


def as_templates(templates) -> list[Template]:
    """Templates, or (name, text) pairs that ask for no words."""
    return [t if isinstance(t, Template) else Template(*t, frozenset()) for t in templates]


def vocabulary_of(templates) -> np.ndarray:
    every = [w for t in as_templates(templates) for w in (t.text, *t.must, *t.never)]
    return np.unique(_of_texts(every)[2])


def document_counts(files: DataFrame, vocabulary: np.ndarray, text: str = "text") -> tuple[int, np.ndarray]:
    """Files, and files that hold each word of the vocabulary; one row per task, word and count travels."""

    def work(rows, buf, at):
        _, row, h = _words(buf, at)
        place = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        known = vocabulary[place] == h
        pairs = np.unique(row[known] * len(vocabulary) + place[known])
        counts = np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        return [pa.array(np.append(np.arange(len(vocabulary)), -1)), pa.array(np.append(counts, len(at) - 1))]

    counted = map_slices(files.select(text), text, "word bigint, n bigint", work).groupBy("word").agg(F.sum("n").alias("n")).collect()
    by_word = {r["word"]: r["n"] for r in counted}
    return by_word.get(-1, 0), np.array([by_word.get(k, 0) for k in range(len(vocabulary))], np.int64)


def model(templates, vocabulary: np.ndarray, n: int, df: np.ndarray) -> Model:
    templates = as_templates(templates)
    idf = np.log((1 + n) / (1 + df)) + 1
    _, row, h = _of_texts([t.text for t in templates])
    matrix = np.zeros((len(vocabulary), len(templates)))
    np.add.at(matrix, (np.searchsorted(vocabulary, h), row), 1)
    matrix *= idf[:, None]
    matrix /= np.linalg.norm(matrix, axis=0)

    def places(words) -> list[int]:
        return np.searchsorted(vocabulary, _of_texts(sorted(words))[2]).tolist() if words else []

    must, never = [places(t.must) for t in templates], [places(t.never) for t in templates]
    words = sorted({p for each in (*must, *never) for p in each})
    ruled = np.full(len(vocabulary), -1)
    ruled[words] = np.arange(len(words))
    tables = [np.zeros((len(templates), len(words)), np.float32) for _ in range(2)]
    for table, lists_ in zip(tables, (must, never)):
        for k, each in enumerate(lists_):
            table[k, ruled[each]] = 1
    # the rarest word that each template asks for; a template that asks for none may mean any unit that shares a word
    anchors = np.zeros(len(vocabulary), bool)
    if all(must):
        anchors[[min(each, key=lambda p: (df[p], p)) for each in must]] = True
    else:
        anchors[:] = True
    names = tuple(t.name for t in templates)
    family = np.array([sorted(set(names)).index(x) for x in names])
    return Model(names, vocabulary, idf, float(np.log(1 + n) + 1), matrix, anchors, ruled, *tables, family)


def cosines(unit: np.ndarray, h: np.ndarray, n_units: int, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Best cosine of each unit and its template, from the units of words and their hashes.

    0 for units that lack the words that templates ask for, and for those that are as near to another licence.
    """
    best, which = np.zeros(n_units), np.zeros(n_units, np.int64)
    place = np.minimum(np.searchsorted(m.vocabulary, h), len(m.vocabulary) - 1)
    known = m.vocabulary[place] == h
    meant = np.zeros(n_units, bool)
    meant[unit[known & m.anchors[place]]] = True
    near = meant[unit]
    unit, h, place, known = unit[near], h[near], place[near], known[near]
    if not len(unit):
        return best, which
    own = h ^ mixed(unit.astype(np.uint64) + np.uint64(1))
    _, first, counts = np.unique(own, return_index=True, return_counts=True)
    unit, place, known = unit[first], place[first], known[first]
    weight = counts * np.where(known, m.idf[place], m.other_idf)
    norm = np.sqrt(np.bincount(unit, weight * weight, minlength=n_units))
    touched, where = np.unique(unit[known], return_inverse=True)
    place, weight = place[known], weight[known]
    order = np.argsort(where, kind="stable")
    for lo in range(0, len(touched), UNITS):
        a, b = np.searchsorted(where[order], (lo, lo + UNITS))
        part = order[a:b]
        row = where[part] - lo
        heads = np.flatnonzero(np.append(True, np.diff(row) > 0))
        dots = np.add.reduceat(m.matrix[place[part]] * weight[part][:, None], heads) / norm[touched[lo : lo + UNITS]][:, None]
        dots = np.round(dots, 12)  # equal but for the order of sums is equal
        held = np.zeros((len(heads), m.must.shape[1]), np.float32)
        asked = m.ruled[place[part]]
        held[row[asked >= 0], asked[asked >= 0]] = 1
        dots[(held @ m.must.T < m.must.sum(1)) | (held @ m.never.T > 0)] = 0
        top = dots.argmax(1)
        score = dots[np.arange(len(heads)), top]
        others = np.where(m.family[None, :] == m.family[top][:, None], 0, dots).max(1)
        score[(score < EXACT) & (score - others < MARGIN)] = 0
        which[touched[lo : lo + UNITS]], best[touched[lo : lo + UNITS]] = top, score
    return best, which


def own_licence(buf, at, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """Best score and template of each row over its lines, its paragraphs and its whole text."""
    n = len(at) - 1
    starts, row, h = _words(buf, at)
    best, which = np.zeros(n), np.zeros(n, np.int64)
    if not len(h):
        return best, which
    breaks = np.append(0, np.cumsum(buf == 10))
    line = breaks[starts] + row  # rows end lines, too
    # a paragraph ends where a line without words lies between
    gap = np.append(0, np.cumsum((np.diff(line) > 1) | (np.diff(row) > 0)))
    for unit in (line, gap, row):
        _, dense = np.unique(unit, return_inverse=True)
        heads = np.flatnonzero(np.append(True, np.diff(dense) > 0))
        score, template = cosines(dense, h, len(heads), m)
        order = np.lexsort((np.arange(len(heads)), template, -score, row[heads]))
        owner = row[heads][order]
        top = order[np.append(True, np.diff(owner) > 0)]
        rows = row[heads][top]
        better = (score[top] > best[rows]) | ((score[top] == best[rows]) & (template[top] < which[rows]))
        best[rows[better]], which[rows[better]] = score[top][better], template[top][better]
    return best, which


def own_licences(files: DataFrame, *, text: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """files with own (a licence name or null) and score (its cosine; the best of a template that may be meant, where no licence is named)."""
    vocabulary = vocabulary_of(templates)
    shared = files.sparkSession.sparkContext.broadcast(model(templates, vocabulary, *document_counts(files, vocabulary, text)))

    def work(rows, buf, at):
        best, which = own_licence(buf, at, shared.value)
        named = best >= least
        return [pa.array([shared.value.names[k] if ok else None for k, ok in zip(which, named)], pa.string()), pa.array(np.minimum(best, 1.0))]

    return add_columns(files, text, FOUND, work)


def directory(path: str) -> Column:
    """Path without its last part; '' at the top, null for a null path."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(F.col(path).isNotNull(), F.lit(""))


def inherited(owned: DataFrame, *, path: str = "path", is_licence_file: Column | None = None) -> DataFrame:
    """Adds licence, origin (own, inherited, none) and origin_directory. `owned` is a stored table with own and score."""
    owned = without(owned, ["licence", "origin", "origin_directory", "_directory", "_from"], path)
    name = F.regexp_replace(path, "^.*/", "")
    is_licence_file = name.rlike(LICENCE_FILE) if is_licence_file is None else is_licence_file
    placed = owned.withColumn("_directory", directory(path))
    files = placed.where(is_licence_file & F.col("own").isNotNull() & F.col("_directory").isNotNull())
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col(path).alias("p"), F.col("own").alias("own")))
    holders = staged(files.groupBy(F.col("_directory").alias("holder")).agg(best.alias("b")).select("holder", F.col("b.own").alias("licence")), "holders")

    folders = placed.select("_directory").where("_directory is not null").distinct()
    parts = F.split("_directory", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    above = folders.select("_directory", F.posexplode(F.array_distinct(ancestors)).alias("depth", "holder"))
    held = _joined(above, holders, "_directory", key="holder", how="inner")
    nearest = staged(held.groupBy("_directory").agg(F.max_by(F.struct("licence", "holder"), "depth").alias("_from")), "nearest")
    joined = _joined(placed, nearest, path)
    has, found = F.col("own").isNotNull(), F.col("_from").isNotNull()
    return joined.select(
        *owned.columns,
        F.coalesce("own", "_from.licence").alias("licence"),
        F.when(has, "own").when(found, "inherited").otherwise("none").alias("origin"),
        F.when(~has, F.col("_from.holder")).alias("origin_directory"),
    )


def _fits(table: DataFrame, few: int) -> bool:
    """Whether a stored table may go through the driver's memory: its rows and bytes are counted, as its files say little about them."""
    n, size = table.agg(F.count("*"), F.sum(F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in table.columns])))).first()
    return n <= few and (size or 0) <= LARGE


def _joined(rows: DataFrame, directories: DataFrame, path: str, few: int = FEW, key: str = "_directory", how: str = "left") -> DataFrame:
    """rows (files, or directories with an ancestor) with what is known of a directory each. A directory may hold any share of the rows.

    Few directories are broadcast, after they are counted; for more, the rows of a directory are dealt by path over PIECES.
    These are merged whatever Spark expects of their size: it takes that from the files, without the copies for the pieces.
    """
    if _fits(directories, few):
        return rows.join(F.broadcast(directories), key, how)
    dealt = rows.withColumn("_piece", F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(path), F.lit(PIECES)).cast("int")))
    every = directories.withColumn("_piece", F.explode(F.array(*[F.lit(k) for k in range(PIECES)])))
    return dealt.join(every.hint("merge"), [key, "_piece"], how).drop("_piece")


def scan(files: DataFrame, *, path: str = "path", text: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """files without their text, with own, score, licence, origin and origin_directory."""
    owned = staged(own_licences(files, text=text, templates=templates, least=least).drop(text), "licences")
    return inherited(owned, path=path)
