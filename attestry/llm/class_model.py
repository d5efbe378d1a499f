"""Scores of texts by a class-based bigram model with exchange-clustered word classes.

P(word | word before) = P(class | class before) * P(word | class). Texts become portions of local
word numbers once; everything else runs on those.

1. Corpus counts of all words; bigrams of the most frequent words (all other words as one class).
2. Exchange: those words move, a quarter per round, to the class that raises the likelihood most.
3. Every other word gets its class by one exchange step, from the classes around all its occurrences.
4. Counts and classes go back to the portions; class transitions are counted over all training texts.
5. Each text's score is the sum of its transitions' and words' log probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.runs import Portions, ascending, groups, pack, unpack
from attestry.llm.words import BLANK_CODES, hash_words, portions, text_bytes, word_table
from attestry.session import materialize

PORTION_BYTES = 16 << 20
#: Words that take part in the rounds of exchange: as many as the model's state on the driver holds.
FREQUENT = 4_096
CLASSES, ROUNDS, TURNS = 64, 12, 4
#: Added per base token; weight of the overall class shares in a class's transitions.
BASE_ADDED, SHARED = 0.1, 10.0
#: The token at a text's end; no word's hash but for 64-bit chance.
END = np.uint64(0)
#: Classes of contexts while clustering: the word classes, all rarer words, the end.
RARER, EDGE = CLASSES, CLASSES + 1
AROUND = CLASSES + 2


def held_out(key: Column) -> Column:
    """Texts that the model does not learn from: crc32 of the key as text is divisible by 10."""
    return F.coalesce(F.crc32(key.cast("string")) % 10 == 0, F.lit(False))


def _table(columns: dict[str, object]) -> Iterator[pa.RecordBatch]:
    return iter(pa.table(columns).to_batches())


# ------------------------------------------------------------------------------- encoding
ENCODED = "portion long, texts binary, words binary, tokens binary"


def encode(docs: DataFrame) -> DataFrame:
    """Portions: texts (doc_id, held_out, number of tokens), distinct words in order, token numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, table = Portions(), word_table(BLANK_CODES)
        for rows in portions(batches, "text", PORTION_BYTES):
            hashes, lengths = hash_words(text_bytes(rows.column("text")), table)
            ends = np.cumsum(lengths)
            words, tokens = np.unique(np.insert(hashes, ends, END), return_inverse=True)
            held = np.array(rows.column("held_out").to_pylist(), bool)
            learned = np.repeat(~held, lengths + 1)
            counts = np.bincount(tokens[learned], minlength=len(words))
            sink = pa.BufferOutputStream()
            texts = pa.table({"doc_id": rows.column("doc_id"), "held_out": held, "n_tokens": lengths + 1})
            with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(texts)
            yield from _table({
                "portion": [number()],
                "texts": [sink.getvalue().to_pybytes()],
                "words": [pack(ascending(words), counts.astype(np.uint32))],
                "tokens": [pack(tokens.astype(np.uint32))],
            })

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, ENCODED)


def _words(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A portion's distinct words in order, and their numbers of training tokens."""
    steps, counts = unpack(block, "<u8", "<u4")
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def _texts(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def _learned(texts: pa.Table) -> np.ndarray:
    """Per token, whether its text is one to learn from."""
    return np.repeat(~np.array(texts.column("held_out")), np.array(texts.column("n_tokens")))


def word_counts(encoded: DataFrame) -> DataFrame:
    """Every training token's number of occurrences: word (hash), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("words").to_pylist():
                words, counts = _words(block)
                seen = counts > 0
                yield from _table({"word": words[seen].view(np.int64), "n": counts[seen]})

    return encoded.select("words").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------------------- exchange
def _numbers(words: np.ndarray, frequent: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the frequent words; len(frequent) for others and one more for the end.

    ``frequent`` is sorted; ``order`` gives the rank of each of its words.
    """
    out = np.full(len(words), len(frequent), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        found = frequent[at] == words
        out[found] = order[at[found]]
    out[words == END] = len(frequent) + 1
    return out


def bigrams(encoded: DataFrame, frequent: np.ndarray, order: np.ndarray) -> DataFrame:
    """Neighbours in training texts, words by rank: left, right, n. The end also stands before a text."""
    size = len(frequent) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, block, tokens in zip(*[batch.column(x).to_pylist() for x in ("texts", "words", "tokens")]):
                numbers = _numbers(_words(block)[0], frequent, order)
                line = numbers[unpack(tokens, "<u4")[0]][_learned(_texts(texts))]
                pairs, n = np.unique(np.roll(line, 1) * size + line, return_counts=True)
                yield from _table({"pair": pairs, "n": n})

    pair = F.col("pair")
    return (
        encoded.select("texts", "words", "tokens").mapInArrow(run, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n"))
        .select((pair / size).cast("int").alias("left"), (pair % size).cast("int").alias("right"), "n")
    )


def _class_contexts(pairs: DataFrame, classes: np.ndarray, words: int) -> np.ndarray:
    """Per frequent word how often each class follows it and stands before it: words x 2 x AROUND.

    The result has a bounded size; the bigrams are summed where they lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(words * 2 * AROUND, np.int64)
        for batch in batches:
            left, right, n = (batch.column(x).to_numpy() for x in ("left", "right", "n"))
            for word, other, side in ((left, right, 0), (right, left, 1)):
                mine = word < words
                np.add.at(total, (word[mine].astype(np.int64) * 2 + side) * AROUND + classes[other[mine]], n[mine])
        cells = np.flatnonzero(total)
        yield from _table({"cell": cells, "n": total[cells]})

    summed = pairs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(words * 2 * AROUND, np.int64)
    out[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(words, 2, AROUND)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _gains(after: np.ndarray, before: np.ndarray, follows: np.ndarray, precedes: np.ndarray) -> np.ndarray:
    """Likelihood gain of adding a word (its context vectors) to every class: CLASSES values.

    ``follows[c, d]`` counts class d after word class c, ``precedes[c, d]`` class d before c.
    """
    total_after, total_before = follows.sum(1), precedes.sum(1)
    gain = (_xlogx(follows + after) - _xlogx(follows)).sum(1) + (_xlogx(precedes + before) - _xlogx(precedes)).sum(1)
    gain -= _xlogx(total_after + after.sum()) - _xlogx(total_after)
    return gain - (_xlogx(total_before + before.sum()) - _xlogx(total_before))


def _class_tables(contexts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class by context class: what follows a class's words and what precedes them."""
    out = np.zeros((2, CLASSES, AROUND))
    for side in (0, 1):
        np.add.at(out[side], classes[: len(contexts)], contexts[:, side])
    return out[0], out[1]


def exchange(pairs: DataFrame, words: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the frequent words by rank, and the two tables of classes and their neighbours.

    Words start in the classes by turns. In each round every fourth word may move to the class with
    the largest gain, so that two neighbours seldom move at once; a round is one sum over the bigrams.
    """
    classes = np.concatenate([np.arange(words) % CLASSES, [RARER, EDGE]])
    contexts = _class_contexts(pairs, classes, words)
    for turn in range(rounds):
        follows, precedes = _class_tables(contexts, classes)
        chosen = classes.copy()
        for word in range(turn % TURNS, words, TURNS):
            after, before = contexts[word].astype(float)
            own = classes[word]
            follows[own] -= after
            precedes[own] -= before
            gains = _gains(after, before, np.maximum(follows, 0), np.maximum(precedes, 0))
            best = int(np.argmax(gains))
            chosen[word] = best if gains[best] > gains[own] else own
            follows[chosen[word]] += after
            precedes[chosen[word]] += before
        if (chosen == classes).all() and turn >= TURNS:
            break
        classes = chosen
        contexts = _class_contexts(pairs, classes, words)
    return classes, *_class_tables(contexts, classes)


# ------------------------------------------------------------------- classes of all other words
OTHERS = "word long, portion long, at int, n int, around binary"


def _others(encoded: DataFrame, frequent: np.ndarray, order: np.ndarray, classes: np.ndarray) -> DataFrame:
    """A portion's rarer words with their place in it and the classes around their training tokens.

    ``around`` has one byte per neighbour: its class after, or AROUND plus its class before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion, texts, block, tokens in zip(*[batch.column(x).to_pylist() for x in ("portion", "texts", "words", "tokens")]):
                words, counts = _words(block)
                numbers = _numbers(words, frequent, order)
                line = unpack(tokens, "<u4")[0][_learned(_texts(texts))]
                kinds = classes[numbers[line]].astype(np.uint8)
                rarer = np.flatnonzero(kinds == RARER)
                places = np.concatenate([line[rarer], line[rarer]])
                codes = np.concatenate([np.roll(kinds, -1)[rarer], np.roll(kinds, 1)[rarer] + np.uint8(AROUND)])
                codes = codes[np.argsort(places, kind="stable")]
                mine = np.flatnonzero(numbers == len(frequent))
                offsets = np.concatenate([[0], np.cumsum(2 * counts[mine])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words[mine].view(np.int64)), pa.array(np.full(len(mine), portion)),
                        pa.array(mine.astype(np.int32)), pa.array(counts[mine].astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(codes.tobytes())]),
                    ],
                    ["word", "portion", "at", "n", "around"],
                )

    return encoded.mapInArrow(run, OTHERS)


PLACED = "portion long, at binary, n binary, class binary, of_class int, types long, times long"


def _step_weights(follows: np.ndarray, precedes: np.ndarray) -> np.ndarray:
    """Gain of one more neighbour of a class, to first order: 2 * AROUND x CLASSES."""
    parts = []
    for table in (follows, precedes):
        smoothed = table + 0.1
        parts.append(np.log(smoothed / smoothed.sum(1, keepdims=True)).T)
    return np.concatenate(parts)


def place_others(others: DataFrame, follows: np.ndarray, precedes: np.ndarray) -> DataFrame:
    """Counts and classes of rarer words, back by portion; and per class its types and tokens.

    Rows of one word are neighbours in a partition sorted by word; a word is done when the next one
    begins. Classes take the largest gain over all neighbours; a word without training tokens has none.
    """
    weights = _step_weights(follows, precedes)

    def done(words, portions_, places, totals, around, lengths) -> Iterator[pa.RecordBatch]:
        firsts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        sizes = np.diff(firsts, append=len(words))
        row_word = np.repeat(np.arange(len(firsts)), sizes)
        n = np.bincount(row_word, weights=totals, minlength=len(firsts)).astype(np.int64)
        chosen = np.zeros(len(firsts), np.uint8)
        code_word = np.repeat(row_word, lengths)
        step = 4_096
        bounds = np.searchsorted(code_word, np.arange(0, len(firsts) + step, step))
        for k in range(len(bounds) - 1):
            low, high = k * step, min((k + 1) * step, len(firsts))
            cells = (code_word[bounds[k] : bounds[k + 1]] - low) * 2 * AROUND + around[bounds[k] : bounds[k + 1]]
            counted = np.bincount(cells, minlength=(high - low) * 2 * AROUND).reshape(-1, 2 * AROUND)
            chosen[low:high] = (counted @ weights).argmax(1)
        known = n > 0
        types = np.bincount(chosen[known], minlength=CLASSES)
        times = np.bincount(chosen[known], weights=n[known], minlength=CLASSES).astype(np.int64)
        order = np.argsort(portions_, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(portions_[order]) != 0]))
        rows = [
            (int(portions_[part[0]]), pack(places[part].astype(np.uint32)), pack(n[row_word[part]]), pack(chosen[row_word[part]]), None, None, None)
            for part in np.split(order, starts[1:])
        ]
        rows += [(None, None, None, None, c, int(types[c]), int(times[c])) for c in np.flatnonzero(types).tolist()]
        names = ("portion", "at", "n", "class", "of_class", "types", "times")
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            around = batch.column("around")
            lengths = pc.binary_length(around).to_numpy().astype(np.int64)
            codes = np.frombuffer(b"".join(around.to_pylist()), np.uint8)
            kept.append((*(batch.column(x).to_numpy() for x in ("word", "portion", "at", "n")), codes, lengths))
            held += batch.num_rows
            if held < 200_000 or kept[0][0][0] == kept[-1][0][-1]:
                continue
            words, in_portion, places, totals, codes, lengths = (np.concatenate(x) for x in zip(*kept))
            end = int(np.searchsorted(words, words[-1]))
            code_end = int(lengths[:end].sum())
            yield from done(words[:end], in_portion[:end], places[:end], totals[:end], codes[:code_end], lengths[:end])
            kept = [(words[end:], in_portion[end:], places[end:], totals[end:], codes[code_end:], lengths[end:])]
            held = len(words) - end
        if held:
            yield from done(*(np.concatenate(x) for x in zip(*kept)))

    return others.repartition("word").sortWithinPartitions("word").mapInArrow(run, PLACED)


# -------------------------------------------------------------------------------- the model
@dataclass(frozen=True)
class Vocabulary:
    """What the corpus counts give: tokens, types, singletons, doubles, ends; the frequent words."""

    tokens: int
    types: int
    once: int
    twice: int
    ends: int
    frequent: np.ndarray
    order: np.ndarray
    counts: np.ndarray

    @property
    def discount(self) -> float:
        """The part of a count that each word gives to unknown ones."""
        share = self.once / (self.once + 2 * self.twice) if self.once else 0.0
        return min(max(share, 0.1), 0.9)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Totals over all words, and the ``FREQUENT`` words with the largest counts."""
    is_end = F.col("word") == int(END)
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.count_if(~is_end & (F.col("n") == 1)),
        F.count_if(~is_end & (F.col("n") == 2)), F.coalesce(F.max(F.when(is_end, F.col("n"))), F.lit(0)),
    ).first()
    top = counts.where(~is_end).orderBy(F.col("n").desc(), "word").limit(FREQUENT).toArrow()
    words = top.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return Vocabulary(*totals, words[order], order, top.column("n").to_numpy())


@dataclass(frozen=True)
class Model:
    """Log10 tables: transitions between states, the discount and the tokens of every class.

    States are the word classes, the end (CLASSES) and unknown words (CLASSES + 1).
    """

    transitions: np.ndarray
    discount: float
    class_tokens: np.ndarray


STATES, UNKNOWN = CLASSES + 2, CLASSES + 1


def build_model(counted: np.ndarray, types: np.ndarray, tokens: np.ndarray, discount: float) -> Model:
    """The model from class transitions in training texts (STATES x STATES) and class sizes.

    Each known word gives ``discount`` of its count to the unknown words of its class; a class without
    words emits unknown words alone. Transitions lean on the overall shares of classes.
    """
    known = counted[:UNKNOWN, :UNKNOWN].astype(float)
    shares = known.sum(0) + 0.5
    shares /= shares.sum()
    to = (known + SHARED * shares) / (known.sum(1, keepdims=True) + SHARED)
    unknown = np.where(tokens > 0, discount * types / np.maximum(tokens, 1), 1.0)
    source = np.where(tokens > 0, types, 1e-9)
    source = source / source.sum()
    full = np.zeros((STATES, STATES))
    full[:UNKNOWN, :UNKNOWN] = to
    full[UNKNOWN, :UNKNOWN] = source @ to[:CLASSES]
    full[:, UNKNOWN] = full[:, :CLASSES] @ unknown
    return Model(np.log10(np.maximum(full, 1e-300)), discount, tokens)


SCORED = "portion long, texts binary, n_known binary, base binary, emission binary, states binary"


def _assemble(encoded: DataFrame, placed: DataFrame, vocabulary: Vocabulary, classes: np.ndarray, model_sizes: np.ndarray) -> DataFrame:
    """Per portion and text: known tokens, base score, words' part of the score, and all states."""
    discount, tokens, types = vocabulary.discount, vocabulary.tokens, vocabulary.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (portion,), rows in groups(batches, ("portion",), ("texts", "words", "tokens", "at", "n", "class")):
            (texts, block, line, *_), *others = rows
            words = _words(block)[0]
            ranks = _numbers(words, vocabulary.frequent, vocabulary.order)
            common = ranks < len(vocabulary.frequent)
            n, state = np.zeros(len(words), np.int64), np.full(len(words), UNKNOWN)
            n[common], state[common] = vocabulary.counts[ranks[common]], classes[ranks[common]]
            n[words == END], state[words == END] = vocabulary.ends, CLASSES
            for *_, at, times, kind in others:
                at = unpack(at, "<u4")[0]
                n[at] = unpack(times, "<i8")[0]
                state[at] = np.where(n[at] > 0, unpack(kind, "u1")[0], UNKNOWN)
            base = np.log10((n + BASE_ADDED) / (tokens + BASE_ADDED * (types + 1)))
            emission = np.zeros(len(words))
            worded = state < CLASSES
            emission[worded] = np.log10((n[worded] - discount) / model_sizes[state[worded]])
            line = unpack(line, "<u4")[0]
            sizes = np.array(_texts(texts).column("n_tokens"))
            starts = np.cumsum(sizes) - sizes
            yield from _table({
                "portion": [portion], "texts": [texts],
                **{
                    name: [pack(np.add.reduceat(values[line], starts))]
                    for name, values in (("n_known", (n > 0).astype(np.int64)), ("base", base), ("emission", emission))
                },
                "states": [pack(state.astype(np.uint8)[line])],
            })

    parts = ("texts", "words", "tokens", "at", "n", "class")

    def columns(df: DataFrame, own: tuple[str, ...], kind: int) -> DataFrame:
        empty = [F.lit(None).cast("binary").alias(x) for x in parts if x not in own]
        return df.select("portion", F.lit(kind).alias("kind"), *own, *empty).select("portion", "kind", *parts)

    return (
        columns(encoded, parts[:3], 0)
        .unionByName(columns(placed.where("portion IS NOT NULL"), parts[3:], 1))
        .repartition("portion").sortWithinPartitions("portion", "kind")
        .select("portion", *parts).mapInArrow(run, SCORED)
    )


def _edges(states: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For every token, state before and own state as one cell; a text begins after an end."""
    before = np.roll(states, 1)
    before[starts] = CLASSES
    return before * STATES + states


def _transitions(scored: DataFrame) -> np.ndarray:
    """How often each state follows each in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(STATES * STATES, np.int64)
        for batch in batches:
            for block, states in zip(batch.column("texts").to_pylist(), batch.column("states").to_pylist()):
                texts = _texts(block)
                sizes = np.array(texts.column("n_tokens"))
                edges = _edges(unpack(states, "u1")[0].astype(np.int64), np.cumsum(sizes) - sizes)
                total += np.bincount(edges[_learned(texts)], minlength=len(total))
        cells = np.flatnonzero(total)
        yield from _table({"cell": cells, "n": total[cells]})

    summed = scored.select("texts", "states").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(STATES * STATES, np.int64)
    out[summed.column("cell").to_numpy()] = summed.column("n").to_numpy()
    return out.reshape(STATES, STATES)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _scores(scored: DataFrame, model: Model, train_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, known, base, emission, states in zip(*[batch.column(x).to_pylist() for x in ("texts", "n_known", "base", "emission", "states")]):
                texts = _texts(block)
                sizes = np.array(texts.column("n_tokens"))
                starts = np.cumsum(sizes) - sizes
                edges = _edges(unpack(states, "u1")[0].astype(np.int64), starts)
                steps = np.add.reduceat(model.transitions.reshape(-1)[edges], starts)
                base_score = unpack(base, "<f8")[0]
                yield from _table({
                    **{x: texts.column(x) for x in ("doc_id", "held_out", "n_tokens")},
                    "n_known": unpack(known, "<i8")[0],
                    "train_tokens": np.full(len(sizes), train_tokens),
                    "base_score": base_score,
                    "score": steps + unpack(emission, "<f8")[0] if train_tokens else base_score,
                })

    return scored.mapInArrow(run, SCORES)


def _learn(docs: DataFrame) -> tuple[DataFrame, Vocabulary, np.ndarray, DataFrame]:
    """Encoded portions, vocabulary, classes of frequent words by rank, and placed other words."""
    encoded = materialize(encode(docs))
    known = vocabulary(materialize(word_counts(encoded)))
    pairs = materialize(bigrams(encoded, known.frequent, known.order))
    classes, follows, precedes = exchange(pairs, len(known.frequent))
    others = _others(encoded, known.frequent, known.order, classes)
    return encoded, known, classes, materialize(place_others(others, follows, precedes))


def score(docs: DataFrame) -> DataFrame:
    """Every text's log10 probability under the class model, beside a smoothed unigram base.

    Words are runs of anything but blanks, A-Z lower-cased; each text ends with an end token. Texts
    whose crc32(doc_id) is divisible by 10 are scored but not learned from; a null doc_id is learned
    from. Columns: doc_id, held_out, n_tokens, n_known (tokens that the training texts hold),
    train_tokens, base_score, score. Null and empty texts are one end token. Rows that repeat count
    each time; other columns are ignored; no rows give none. Without a training text every token is
    unknown, and ``score`` is ``base_score``. Words are told apart by 64-bit hashes.
    """
    encoded, known, classes, placed = _learn(docs)
    sizes = np.zeros((2, CLASSES))
    for row in placed.where("of_class IS NOT NULL").groupBy("of_class").agg(F.sum("types"), F.sum("times")).collect():
        sizes[:, row[0]] = row[1:]
    np.add.at(sizes[0], classes[: len(known.frequent)], 1)
    np.add.at(sizes[1], classes[: len(known.frequent)], known.counts)
    scored = materialize(_assemble(encoded, placed, known, classes, sizes[1]))
    model = build_model(_transitions(scored), sizes[0], sizes[1], known.discount)
    return _scores(scored, model, known.tokens)
