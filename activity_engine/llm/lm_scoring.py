"""Language-model scoring with a weighted backoff automaton (operator 8).

The model is an interpolated absolute-discounting n-gram model over all words and
all n-grams, seen once or more, of the training documents. Every word has its own
unigram probability, (c + 1) / (N + V + 1), and one more share stands for all words
never seen.

Contexts seen in training are states, n-grams arcs, and each state has a failure arc
with its backoff weight to the next shorter context. Their number grows with the
corpus, so they are dealt to tasks:

1. Texts are cut into batches of about _BATCH tokens, written once as numbers.
2. Of a batch, each distinct arc goes once, with its count, to the task of its state.
   That task has all training counts of the state, so it knows the state's count, its
   arcs and their counts. A state's count is also the count of the bigram that leads
   to it; states go by their first word, so the task of a word knows its arcs too.
3. The answers go back to the batch in the order of its questions, and are summed a
   text, from the unigram up to the trigram.

Words of relative frequency 2**-WORD_BITS or more have short numbers, which are
broadcast. Of words and states of about 2**-NGRAM_BITS or more (at most 2**NGRAM_BITS
and twice that) the arcs are dealt one by one; what their tasks count is summed and
broadcast. Both decide only how a row is dealt or written, never its score. An arc is
one row a batch, however frequent, so no task gets more than its share.

Words are compared by 63-bit hashes. Defined results: a null or empty text is its
end token alone; without training documents every token is unseen; repeated rows
are scored and counted as rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import crc_mod, materialize, mix64

ORDER = 3
WORD_BITS = 20
NGRAM_BITS = 13
DISCOUNT = 0.75
#: Tokens of a batch of texts, and those whose arcs a task counts.
_BATCH = 3 << 18
_PART = 1 << 20


def _keys(words: list[bytes]) -> np.ndarray:
    """63-bit hashes of words, below 0; numbers of words are not."""
    return ~(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) >> np.uint64(1)).astype(np.int64)


#: No word: what follows the end token (which is a blank, as no word is).
NONE = -1 << 63


def tokens(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of texts, A-Z lowered, the place of each token among them, and tokens a text.

    The last one is the end token, which follows the words of each text.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    places = np.asarray(coded.indices).astype(np.int64)
    real = places != (words.index(b"") if b"" in words else -1)
    ends = np.append(0, np.cumsum(real))[np.cumsum(np.asarray(parts.value_lengths()), dtype=np.int64)]
    words.append(b" ")
    return words, np.insert(places[real], ends, len(words) - 1), np.diff(ends, prepend=0) + 1


def _count_words(batches):
    """Counts of the words that may be frequent in all texts; the row of NONE has all tokens."""
    waiting, size = [], 0

    def flush():
        keys, place = np.unique(np.concatenate([k for k, _ in waiting]), return_inverse=True)
        uses = np.bincount(place, np.concatenate([n for _, n in waiting])).astype(np.int64)
        own = uses << WORD_BITS >= size
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(NONE, keys[own])), pa.array(np.append(size, uses[own]))], ["h", "n"])

    for batch in batches:
        words, places, _ = tokens(batch.column("_text"))
        waiting.append((_keys(words), np.bincount(places, minlength=len(words))))
        size += len(places)
        if size >= 2 * _BATCH:
            yield flush()
            waiting, size = [], 0
    if size:
        yield flush()


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers, most of them small, as bytes: those of one weight side by side."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T) for c in columns]
    return pa.compress(np.concatenate(planes), codec="zstd", asbytes=True)


def _unpack(packed: bytes, columns: int, size: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, columns * size * 8, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, size).transpose(0, 2, 1)).view("<i8")[:, :, 0]


def _batches(numbering, strong: int):
    """Texts -> a row a batch: its tokens' numbers, NONE after each text, and its frequent states."""

    def run(batches):
        frequent_keys, numbers = numbering.value
        task, done = TaskContext.get().partitionId() << 32, 0
        waiting, ids, held_out, size = [], [], [], 0

        def flush():
            x = np.concatenate(waiting)
            train = ~np.concatenate([np.asarray(h.cast(pa.uint8())).astype(bool) for h in held_out])
            counted = np.diff(np.flatnonzero(x == NONE), prepend=-1) - 1
            near = (x >= 0) & (x < strong)
            pairs, uses = np.unique((x[:-1] * strong + x[1:])[near[:-1] & near[1:]], return_counts=True)
            frequent = uses << NGRAM_BITS >= len(x)
            lists = [pa.chunked_array(ids).combine_chunks(), pa.chunked_array(held_out).combine_chunks(),
                     pa.array(pairs[frequent]), pa.array(uses[frequent])]
            return pa.RecordBatch.from_arrays(
                [pa.array([task + done]), pa.array([int(counted[train].sum())]), pa.array([len(x)], pa.int32()),
                 pa.array([_pack(x)], pa.binary())]
                + [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a) for a in lists],
                ["batch", "learned", "size", "data", "ids", "held_out", "pairs", "uses"])

        for batch in batches:
            words, places, sizes = tokens(batch.column("_text"))
            values = _keys(words)
            at, known = _find(values, frequent_keys)
            values[known] = numbers[at[known]]
            waiting.append(np.insert(values[places], np.cumsum(sizes), NONE))
            ids.append(batch.column("doc_id"))
            held_out.append(batch.column("held_out"))
            size += len(waiting[-1])
            if size >= _BATCH:
                yield flush()
                done, size = done + 1, 0
                for own in (waiting, ids, held_out):
                    own.clear()
        if size:
            yield flush()

    return run


def _changes(*columns) -> np.ndarray:
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _find(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``values`` in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return at, table[at] == values


def _dense(x: np.ndarray, numbered: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for all words of ``x``, the rare ones' after the others', and the rare words."""
    rare = x < 0
    words, place = np.unique(x[rare], return_inverse=True)
    ids = x.copy()
    ids[rare] = numbered + place
    return ids, words


def _distinct(u: np.ndarray, v: np.ndarray, w: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Of triples of numbers below ``kinds``: each one's place among the distinct ones, sorted, and a place of each of these."""
    pair = u * kinds + v
    if kinds > 1 << 21:  # three numbers of more than 21 bits do not fit
        pair = np.unique(pair, return_inverse=True)[1]
    found, place = np.unique(pair * kinds + w, return_inverse=True)
    at = np.empty(len(found), np.int64)
    at[place] = np.arange(len(place))
    return place, at


class Deal:
    """How arcs are dealt: by their state's first word; of a frequent word by state, of a frequent state one by one."""

    def __init__(self, numbered: int, strong: int, states: np.ndarray, parts: int):
        self.numbered, self.strong, self.states, self.parts = numbered, strong, states, parts

    def frequent(self, u, v) -> tuple[np.ndarray, np.ndarray]:
        """Places of states among the frequent ones, and whether they are there."""
        near = (u >= 0) & (u < self.strong) & (v >= 0) & (v < self.strong)
        return _find(np.where(near, u * self.strong + v, -1), self.states)

    def part(self, u, v, w) -> np.ndarray:
        code = mix64(u.astype(np.uint64))
        by_state = (u >= 0) & (u < self.strong) & (v != NONE)
        code[by_state] = mix64(code + v.astype(np.uint64))[by_state]
        by_arc = self.frequent(u, v)[1]
        code[by_arc] = mix64(code + w.astype(np.uint64))[by_arc]
        return (code % np.uint64(self.parts)).astype(np.int32)

    def questions(self, x: np.ndarray) -> dict:
        """Distinct arcs and words of a batch (a word's is (word, NONE, NONE)) in the order of their parts.

        ``of_arc`` and ``of_word`` have the question of each token from the third of a
        text on, and of each token; ``deep`` the places of the former.
        """
        ids, rare = _dense(x, self.numbered)
        deep = 2 + np.flatnonzero((x[:-2] != NONE) & (x[1:-1] != NONE))
        of_arc, at = _distinct(ids[deep - 2], ids[deep - 1], ids[deep], self.numbered + len(rare))
        at = deep[at]
        words, of_word = np.flatnonzero(uses := np.bincount(ids)), np.zeros(len(uses), np.int64)
        of_word[words] = np.arange(len(words))
        single = np.append(np.arange(self.numbered), rare)[words]
        none = np.full(len(single), NONE)
        u, v, w = np.append(x[at - 2], single), np.append(x[at - 1], none), np.append(x[at], none)
        part = self.part(u, v, w)
        order = np.argsort(part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return {"u": u[order], "v": v[order], "w": w[order], "part": part[order], "deep": deep,
                "of_arc": place[of_arc], "of_word": place[len(at) + of_word[ids]]}


def _ask(deal):
    """Batches -> a row a batch and part: the questions with their counts in training texts."""

    def run(batches):
        for batch in batches:
            for size, data, held_out, number in zip(*[batch.column(n).to_pylist() for n in ("size", "data", "held_out", "batch")]):
                x = _unpack(data, 1, size)[0]
                asked = deal.value.questions(x)
                train = np.repeat(~np.array(held_out, bool), np.diff(np.flatnonzero(x == NONE), prepend=-1))
                n = (np.bincount(asked["of_arc"], train[asked["deep"]], len(asked["u"]))
                     + np.bincount(asked["of_word"], train, len(asked["u"]))).astype(np.int64)
                cuts = np.flatnonzero(_changes(asked["part"]))
                ends = np.append(cuts[1:], len(n))
                rows = [_pack(*[a[i:j] for a in (asked["u"], asked["v"], asked["w"], n)]) for i, j in zip(cuts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), number)), pa.array(asked["part"][cuts]),
                     pa.array((ends - cuts).astype(np.int32)), pa.array(rows, pa.binary())],
                    ["batch", "part", "size", "data"])

    return run


def _answer(deal):
    """All questions of a part -> for each the counts of its arc and state, and the state's number of arcs.

    A word's state is the word. Rows of ``key`` have the part's share of what several
    parts count: -1 the words in training texts, -2 - u the arcs of a frequent word,
    others the frequent states.
    """

    def run(batches):
        rows = [r for b in batches for r in zip(*[b.column(n).to_pylist() for n in ("batch", "part", "size", "data")])]
        if not rows:
            return
        u, v, w, n = np.concatenate([_unpack(data, 4, size) for *_, size, data in rows], axis=1)
        numbered, strong = deal.value.numbered, deal.value.strong
        ids, rare = _dense(np.concatenate([u, v, w]), numbered)
        place, at = _distinct(*np.split(ids, 3), numbered + len(rare))
        del ids
        count = np.bincount(place, n).astype(np.int64)
        first = np.flatnonzero(_changes(u[at], v[at]))
        of_state = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
        total = np.bincount(of_state, count).astype(np.int64)
        kinds = np.bincount(of_state, (count > 0) & (w[at] != NONE)).astype(np.int64)
        u, v = u[at][first], v[at][first]
        where, frequent = deal.value.frequent(u, v)
        word, by_word = v == NONE, np.cumsum(_changes(u)) - 1
        arcs = np.bincount(by_word, (total > 0) & ~word & ~frequent).astype(np.int64)
        kinds[word] = arcs[by_word[word]]
        own = np.flatnonzero(_changes(u) & (u >= 0) & (u < strong))
        keys = np.concatenate([[-1], -2 - u[own], deal.value.states[where[frequent]]])
        nothing = np.zeros(len(own), np.int64)
        shares = pa.RecordBatch.from_arrays(
            [pa.nulls(len(keys), t) for t in (pa.int64(), pa.int32(), pa.int32(), pa.binary())] + [pa.array(keys)]
            + [pa.array(np.concatenate(a)) for a in (([((total > 0) & word & (u != NONE)).sum()], nothing, total[frequent]),
                                                     ([0], arcs[by_word[own]], kinds[frequent]))],
            ["batch", "part", "size", "data", "key", "c", "kinds"])
        yield shares
        found, done = np.stack([count, total[of_state], kinds[of_state]]), 0
        for batch, part, size, _ in rows:
            asked = place[done:done + size]
            done += size
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch]), pa.array([part], pa.int32()), pa.array([size], pa.int32()),
                 pa.array([_pack(*found[:, asked])], pa.binary())] + [pa.nulls(1, pa.int64())] * 3, shares.schema.names)

    return run


def _score(deal, model, order: int):
    """Rows sorted by batch and part, that of the texts first -> the figures of each text."""

    def scored(rows):
        states, kinds_of_states, kinds_of_words, share = model.value
        (_, size, data, ids, held_out), answers = rows[0], rows[1:]
        x = _unpack(data, 1, size)[0]
        asked = deal.value.questions(x)
        n, c, kinds = np.concatenate([_unpack(d, 3, s) for _, s, d, *_ in answers], axis=1)
        u, v = asked["u"], asked["v"]
        at, frequent = deal.value.frequent(u, v)
        c[frequent], kinds[frequent] = states[at[frequent]], kinds_of_states[at[frequent]]
        frequent = (v == NONE) & (u >= 0) & (u < len(kinds_of_words))
        kinds[frequent] = kinds_of_words[u[frequent]]
        wc, wk = c[asked["of_word"]], kinds[asked["of_word"]]
        deep = asked["deep"]
        arc, state, arcs = np.zeros((3, len(x)), np.int64)
        arc[deep], state[deep], arcs[deep] = n[asked["of_arc"]], c[asked["of_arc"]], kinds[asked["of_arc"]]
        ends = np.flatnonzero(x == NONE)
        begins = np.append(0, ends[:-1] + 1)
        p = unigram = (wc + 1) / share
        if order >= 2:
            before = np.roll(wc, 1)
            before[begins] = 0
            p = _interpolated(before, np.roll(wk, 1), np.append(state[1:], 0), p)  # the next token's state is this one's bigram
        if order >= 3:
            p = _interpolated(state, arcs, arc, p)
        word = x != NONE
        return pa.RecordBatch.from_arrays(
            [ids, held_out, pa.array(ends - begins), pa.array(np.add.reduceat((word & (wc > 0)).astype(np.int64), begins)),
             pa.array(np.add.reduceat(np.log10(np.where(word, unigram, 1.0)), begins)),
             pa.array(np.add.reduceat(np.log10(np.where(word, p, 1.0)), begins))],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    def run(batches):
        waiting: list[tuple] = []
        for batch in batches:
            ids, held_out = batch.column("ids"), batch.column("held_out")
            for i, (number, size, data) in enumerate(zip(*[batch.column(n).to_pylist() for n in ("batch", "size", "data")])):
                if waiting and waiting[0][0] != number:
                    yield scored(waiting)
                    waiting = []
                texts = (ids[i].values, held_out[i].values) if not waiting else (None, None)
                waiting.append((number, size, data, *texts))
        if waiting:
            yield scored(waiting)

    return run


def _interpolated(total: np.ndarray, kinds: np.ndarray, count: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Probability of an arc, or by the failure arc, from a state; the shorter one's without a state."""
    seen = np.maximum(total, 1)
    own = np.where(count > 0, count - DISCOUNT, 0) / seen + DISCOUNT * kinds / seen * shorter
    return np.where(total > 0, own, shorter)


def _arrays(rows: DataFrame, *names: str) -> list[np.ndarray]:
    got = rows.select(*names).toArrow().sort_by(names[0])
    return [np.asarray(got.column(n).combine_chunks()) for n in names]


def lm_scores(docs: DataFrame, training: F.Column, text_col: str = "text", id_col: str = "doc_id",
              order: int = ORDER) -> DataFrame:
    """doc_id, held_out (not ``training``), n_tokens, n_known, train_tokens, base_score, score of each row."""
    if not 1 <= order <= 3:
        raise ValueError(f"order {order}: n-grams of one to three words are scored")
    context = docs.sparkSession.sparkContext
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), (~training).alias("held_out"),
                         F.col(text_col).alias("_text"))
    words = materialize(source.select("_text").mapInArrow(_count_words, "h long, n long")
                        .groupBy("h").agg(F.sum("n").alias("n")), "words", drop_shuffles=True)
    every = words.filter(F.col("h") == NONE).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    keys, uses = _arrays(words.filter((F.col("h") != NONE) & (F.col("n") * (1 << WORD_BITS) >= every)), "h", "n")
    numbers = np.empty(len(keys), np.int64)
    numbers[np.argsort(-uses, kind="stable")] = np.arange(len(keys))
    strong = int((uses * (1 << NGRAM_BITS) >= every).sum())

    texts = materialize(source.mapInArrow(
        _batches(context.broadcast((keys, numbers)), strong),
        "batch long, learned long, size int, data binary, ids array<long>, held_out array<boolean>,"
        " pairs array<long>, uses array<long>"), "texts")
    many, total = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("learned"), F.lit(0))).first()
    states, _ = _arrays(texts.select(F.explode(F.arrays_zip("pairs", "uses")).alias("_")).select("_.*").groupBy("pairs")
                        .agg(F.sum("uses").alias("n")).filter(F.col("n") * (2 << NGRAM_BITS) >= every), "pairs", "n")
    parts = int(every) // _PART + 1
    deal = context.broadcast(Deal(len(keys), strong, states, parts))
    found = materialize(
        texts.select("batch", "size", "data", "held_out").mapInArrow(_ask(deal), "batch long, part int, size int, data binary")
        .repartitionById(parts, F.col("part"))
        .mapInArrow(_answer(deal), "batch long, part int, size int, data binary, key long, c long, kinds long"), "answers", drop_shuffles=True)

    key, c, kinds = _arrays(found.filter("key is not null").groupBy("key")
                            .agg(F.sum("c").alias("c"), F.sum("kinds").alias("kinds")), "key", "c", "kinds")
    counts, arcs, of_words = (np.zeros(n, np.int64) for n in (len(states), len(states), strong))
    at, known = _find(key, states)
    counts[at[known]], arcs[at[known]] = c[known], kinds[known]
    of_words[-2 - key[key < -1]] = kinds[key < -1]
    np.add.at(of_words, states // max(strong, 1), counts > 0)
    model = context.broadcast((counts, arcs, of_words, float(total + c[key == -1].sum() + 1)))
    rows = texts.select("batch", F.lit(-1).alias("part"), "size", "data", "ids", "held_out").union(
        found.filter("key is null").select("batch", "part", "size", "data", F.lit(None).cast("array<long>"),
                                           F.lit(None).cast("array<boolean>")))
    scored = rows.repartition(max(many, 1), "batch").sortWithinPartitions("batch", "part").mapInArrow(
        _score(deal, model, order), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def score_digest(docs: DataFrame) -> DataFrame:
    """The columns of query ``op8_lm_scoring``."""
    return lm_scores(docs, crc_mod("doc_id", 7) != 2)
