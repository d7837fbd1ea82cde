"""Language identification by cross-parsing against suffix automata of labelled text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import held_out, id_and_text, importable, small_slices
from sessionlake.session import materialize

# Characters of labelled text per language that an automaton is built from: a bounded sample.
SAMPLE_CHARS = 40_000

# The sample has an excerpt of each of its documents, so that no long one fills it.
EXCERPT_CHARS = 800

# Long texts are walked in pieces of so many characters, side by side; see `phrase_counts`.
PIECE = 2048

_SPACE = 0

UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def alphabet_of(texts: Iterable[str]) -> np.ndarray:
    """All letters of the texts, as code points in order."""
    found = [np.unique(_codes(t)) for t in texts]
    codes = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint32)
    return codes[_letters()[codes]].astype(np.int64)


def symbol_table(alphabet: np.ndarray) -> np.ndarray:
    """Code point to symbol: 0 for what is no letter, then the letters of the alphabet, however
    many, and the last one for all other letters, which are in no labelled text."""
    table = np.where(_letters(), len(alphabet) + 1, _SPACE).astype(np.int32)
    table[alphabet] = np.arange(1, len(alphabet) + 1)
    return table


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """A text's symbols, runs of non-letters as one space."""
    out = table[_codes(text)]
    if len(out) > 1:
        keep = np.ones(len(out), dtype=bool)
        keep[1:] = (out[1:] != _SPACE) | (out[:-1] != _SPACE)
        out = out[keep]
    return out


def suffix_automaton(sequences: list[np.ndarray]) -> np.ndarray:
    """Transitions of the automaton of all substrings of the sequences, in rows of state, symbol
    and target, by state.

    State 0 is the root. No match crosses from one sequence to the next: the construction starts
    each at the root.
    """
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def extend(last: int, symbol: int) -> int:
        known = moves[last].get(symbol)
        if known is not None and length[known] == length[last] + 1:
            return known

        def split(state: int, target: int) -> int:
            copy = len(moves)
            moves.append(dict(moves[target]))
            link.append(link[target])
            length.append(length[state] + 1)
            while state != -1 and moves[state].get(symbol) == target:
                moves[state][symbol] = copy
                state = link[state]
            link[target] = copy
            return copy

        if known is not None:
            return split(last, known)
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        state = last
        while state != -1 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state != -1:
            target = moves[state][symbol]
            link[new] = target if length[target] == length[state] + 1 else split(state, target)
        return new

    for sequence in sequences:
        last = 0
        for symbol in sequence.tolist():
            last = extend(last, symbol)
    rows = [(state, c, to) for state, out in enumerate(moves) for c, to in sorted(out.items())]
    return np.array(rows, dtype=np.int32).reshape(-1, 3)


def _packed(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions in one array without their many gaps: that of state ``s`` by symbol ``c`` is at
    ``base[s] + c``, where ``owner`` names the state and ``target`` the next one. States with
    most transitions are placed first, each not far below the last one, where all of its places
    are free; those with one transition then fill the gaps from the start."""
    n_states = int(rows[:, [0, 2]].max(initial=0)) + 1
    starts = np.searchsorted(rows[:, 0], np.arange(n_states + 1))
    width = int(rows[:, 1].max(initial=0)) + 1
    taken = bytearray(2 * len(rows) + 2 * width)
    base = np.zeros(n_states, np.int32)
    last = lowest = 0
    for state in np.argsort(-np.diff(starts), kind="stable").tolist():
        mine = rows[starts[state] : starts[state + 1], 1].tolist()
        if not mine:
            break
        at = lowest if len(mine) == 1 else max(0, last - 4 * width)
        while True:
            at = taken.find(0, at)  # a free place for the first transition
            if at < 0 or at + width > len(taken):
                at = max(at, 0)
                taken.extend(bytes(len(taken)))
                at = taken.find(0, at)
            offset = at - mine[0]
            if offset >= 0 and not any(taken[offset + c] for c in mine):
                break
            at += 1
        for c in mine:
            taken[offset + c] = 1
        base[state] = offset
        if len(mine) == 1:
            lowest = at
        else:
            last = max(last, at)
    owner = np.full(len(taken) + width, -1, np.int32)
    target = np.zeros(len(taken) + width, np.int32)
    place = base[rows[:, 0]] + rows[:, 1]
    owner[place], target[place] = rows[:, 0], rows[:, 2]
    return base, owner, target


@dataclass
class Model:
    """The automata of all languages, one after the other, and their common alphabet."""

    languages: list[str]
    alphabet: np.ndarray
    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray
    roots: np.ndarray
    anew: np.ndarray  # language by symbol: where a phrase that starts with it begins

    @classmethod
    def of(cls, automata: dict[str, np.ndarray], alphabet: np.ndarray) -> Model:
        languages, width = sorted(automata), len(alphabet) + 2
        bases, owners, targets, roots, state, place = [], [], [], [], 0, 0
        for name in languages:
            base, owner, target = _packed(automata[name])
            bases.append(base + np.int32(place))
            owners.append(np.where(owner >= 0, owner + np.int32(state), np.int32(-1)))
            targets.append(target + np.int32(state))
            roots.append(state)
            state, place = state + len(base), place + len(owner)
        empty = np.zeros(0, np.int32)
        # any symbol may be looked up from the last base
        owners.append(np.full(width, -1, np.int32))
        targets.append(np.zeros(width, np.int32))
        base, owner, target = (np.concatenate(x) if x else empty for x in (bases, owners, targets))
        starts = np.array(roots, np.int32)
        first = base[starts][:, None] + np.arange(width) if roots else np.zeros((0, width), np.int64)
        anew = np.where(owner[first] == starts[:, None], target[first], starts[:, None])
        return cls(languages, alphabet, base, owner, target, starts, anew.astype(np.int32))

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, language by text, and where a phrase has ended before the symbol."""
        at = self.base[state] + symbol
        ended = self.owner[at] != state
        return np.where(ended, self.anew[:, symbol], self.target[at]), ended


def phrase_counts(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """How many phrases each text (as symbols) needs in each language: text by language.

    A phrase is the longest stretch from where the last one ended that occurs in the language's
    text. All pieces of all texts walk all automata together, a symbol at a time, each from the
    root. Then the pieces of a text are put together, in order: the walk that really comes from
    the piece before goes along with the one from the root until both are in the same state; from
    there on the latter holds.
    """
    counts = np.zeros((len(texts), len(model.languages)), dtype=np.int64)
    pieces = [(i, a // PIECE, t[a : a + PIECE]) for i, t in enumerate(texts) for a in range(0, len(t), PIECE)]
    pieces.sort(key=lambda p: -len(p[2]))
    if not pieces or not model.languages:
        return counts
    lengths = np.array([len(p) for _, _, p in pieces])
    grid = np.zeros((int(lengths[0]), len(pieces)), dtype=np.int32)
    for k, (_, _, piece) in enumerate(pieces):
        grid[: len(piece), k] = piece
    final = np.repeat(model.roots[:, None], len(pieces), axis=1)
    n = np.zeros(final.shape, dtype=np.int64)
    live = len(pieces)
    alive = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")
    state = final.copy()
    for step in range(len(grid)):
        if alive[step] < live:
            final[:, alive[step] : live] = state[:, alive[step] :]
            live = int(alive[step])
            state = np.ascontiguousarray(state[:, :live])
        state, ended = model.step(state, grid[step, :live])
        n[:, :live] += ended
    final[:, :live] = state
    _join_pieces(model, pieces, grid, lengths, n, final)
    owner = np.array([i for i, _, _ in pieces])
    for k in range(len(model.languages)):
        counts[:, k] = np.bincount(owner, n[k], minlength=len(texts))
    counts[[len(t) > 0 for t in texts]] += 1
    return counts


def _join_pieces(
    model: Model, pieces: list, grid: np.ndarray, lengths: np.ndarray, n: np.ndarray, final: np.ndarray
) -> None:
    """Correct ``n`` and ``final`` of all pieces but the first ones for where they really start."""
    place = {(text, k): at for at, (text, k, _) in enumerate(pieces)}
    turn = 1
    follow = np.array(sorted(at for (_, k), at in place.items() if k == turn), np.int64)
    while len(follow):
        before = np.array([place[pieces[at][0], turn - 1] for at in follow])
        real = final[:, before]
        anew = np.repeat(model.roots[:, None], len(follow), axis=1)
        apart, step = real != anew, 0
        while apart.any() and step < int(lengths[follow].max()):
            inside = apart & (step < lengths[follow])
            symbol = grid[step, follow]
            real_next, real_ended = model.step(real, symbol)
            anew_next, anew_ended = model.step(anew, symbol)
            n[:, follow] += np.where(inside, real_ended.astype(np.int64) - anew_ended, 0)
            real, anew = np.where(inside, real_next, real), np.where(inside, anew_next, anew)
            apart &= real != anew
            step += 1
        final[:, follow] = np.where(apart, real, final[:, follow])
        turn += 1
        follow = np.array(sorted(at for (_, k), at in place.items() if k == turn), np.int64)


def _sample(docs: DataFrame, sample_chars: int) -> DataFrame:
    """``lang``, ``at`` (a seeded order), ``text``: excerpts of about three times the wanted
    characters per language, so that a language's rows stay bounded.

    Rows are drawn by id and text, and rows equal in both count once; so neither a repeated id nor
    a repeated row fills the sample.
    """
    spark = docs.sparkSession
    labelled = docs.select("doc_id", "text", "lang").filter("lang is not null and length(text) > 0")
    own = F.xxhash64("doc_id", "text")
    labelled = labelled.withColumn("at", F.pmod(F.xxhash64(F.lit(7), own), F.lit(1 << 60)))
    size = F.least(F.char_length("text"), F.lit(EXCERPT_CHARS))
    # one number per language
    totals = labelled.groupBy("lang", "at").agg(F.max(size).alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))
    shares = spark.createDataFrame(
        [(r["lang"], min(1.0, 3.0 * sample_chars / r["n"])) for r in totals.collect()],
        "lang string, share double",
    )
    spare = F.greatest(F.char_length("text") - EXCERPT_CHARS, F.lit(0)) + 1
    start = F.pmod(F.xxhash64(F.lit(8), "doc_id"), spare) + 1
    return (
        labelled.join(F.broadcast(shares), "lang")
        .filter(F.col("at") / F.lit(float(1 << 60)) <= F.col("share"))
        .select("lang", "at", F.substring("text", start.cast("int"), F.lit(EXCERPT_CHARS)).alias("text"))
        .groupBy("lang", "at")
        .agg(F.min("text").alias("text"))
    )


def _trimmed(rows: pd.DataFrame, sample_chars: int) -> list[str]:
    """The first texts of the seeded order, up to the wanted characters."""
    out, left = [], sample_chars
    for text in rows.sort_values(["at", "text"])["text"]:
        out.append(text[:left])
        left -= len(text)
        if left <= 0:
            break
    return out


def _build(sample: DataFrame, alphabet: np.ndarray, sample_chars: int) -> Model:
    """An automaton per language, each by a task of its own."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        table = symbol_table(alphabet)
        automaton = suffix_automaton([symbols(t, table) for t in _trimmed(rows, sample_chars)])
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "moves": [automaton.tobytes()]})

    built = sample.groupBy("lang").applyInPandas(build, "lang string, moves binary").collect()
    return Model.of({r["lang"]: np.frombuffer(r["moves"], np.int32).reshape(-1, 3) for r in built}, alphabet)


def train(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Build an automaton per language from labelled documents (``doc_id``, ``text``, ``lang``).

    Excerpts of documents are taken in a seeded order until ``sample_chars`` characters are
    reached, rows of equal id and text as one. The alphabet is all letters of the sample. Labelled
    documents quote other languages; so excerpts that automata of the other
    half of the sample take for another language are left out first, unless that is all of
    a language. Rows without a language or a text teach nothing.
    """
    spark = docs.sparkSession
    importable(spark)
    sample = materialize(_sample(docs, sample_chars), "language-sample")

    def letters(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"letters": [alphabet_of(_trimmed(rows, sample_chars)).tolist()]})

    found = sample.groupBy("lang").applyInPandas(letters, "letters array<long>").collect()
    alphabet = np.unique(np.array([c for row in found for c in row["letters"]], dtype=np.int64))

    halves = [_build(sample.filter(F.col("at") % 2 == k), alphabet, sample_chars // 4) for k in (0, 1)]
    judges = spark.sparkContext.broadcast(halves)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbol_table(alphabet)
        for rows in small_slices(batches):
            texts = [symbols(t, table) for t in rows.column("text").to_pylist()]
            langs = rows.column("lang").to_pylist()
            fits = [True] * len(texts)
            for k, model in enumerate(judges.value):
                mine = [i for i, at in enumerate(rows.column("at").to_pylist()) if at % 2 != k]
                counts = phrase_counts(model, [texts[i] for i in mine])
                for i, n in zip(mine, counts, strict=True):
                    if langs[i] in model.languages:
                        fits[i] = bool(n[model.languages.index(langs[i])] == n.min())
            yield pa.record_batch([*rows.columns, pa.array(fits)], [*rows.schema.names, "fits"])

    judged = sample.mapInArrow(judge, "lang string, at long, text string, fits boolean")
    judged = materialize(judged, "language-judged")
    some = judged.groupBy("lang").agg(F.max("fits").alias("some"))
    clean = judged.join(some, "lang").filter("fits or not some").select("lang", "at", "text")
    return _build(clean, alphabet, sample_chars)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` for every row of ``docs``.

    The language whose text yields the fewest phrases wins; of a tie, the first by name. The
    score is the runner-up's share of the two counts, 0.5 to 1. Texts that are null or have no
    letter are ``und`` with score 0, as is everything if no language was learned.
    """
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table, letters = shared.value, symbol_table(shared.value.alphabet), _letters()
        for rows in small_slices(batches, max_bytes=8 << 20):
            texts = [t or "" for t in rows.column("text").to_pylist()]
            counts = phrase_counts(model, [symbols(t, table) for t in texts])
            names, scores = [], []
            for text, n in zip(texts, counts, strict=True):
                if not len(n) or not letters[_codes(text)].any():
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best = int(np.argmin(n))
                others = np.delete(n, best)
                names.append(model.languages[best])
                scores.append(float(others.min() / (others.min() + n[best])) if len(others) else 1.0)
            yield pa.record_batch(
                [rows.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return id_and_text(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def identify_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: learn from the rows that aren't held out, predict all rows."""
    model = train(docs.filter(~held_out("doc_id", 4, 2)))
    return identify(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score"
    )
