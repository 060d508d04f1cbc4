"""Subject areas of documents by label propagation over a graph of verified passage similarity."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..operators.distributed import cut, replicate, salt_of

#: The label of documents outside all subjects; it is propagated like a subject and left out of results.
OUTSIDE = "-"
#: Up to so many nodes, tables of them are broadcast; beyond, they are joined by shuffles with the same result.
BROADCAST_NODES = 2_000_000
#: Words kept in a worker's table before it is emptied.
MEMO = 500_000
#: A link is sentence * 2**_SHIFT + node; later sentences than 2**18 of a document count as one.
_SHIFT = 44
_MASK, _LAST = (1 << _SHIFT) - 1, (1 << 18) - 1


class Words:
    """Words of three letters and more as 64-bit hashes, with document and sentence of each.

    Words are runs of letters in lower case, a final s of longer words dropped; markup is skipped.
    Sentence 0 is the title.
    """

    def __init__(self):
        import xxhash

        self.markup = re.compile(r"<[^<>]*>|&\w+;")
        self.tokens = re.compile(r"[^\W\d_]+|[.!?](?=\s)").findall
        self.marks = str.maketrans(".!?", "   ")

        class Memo(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= MEMO:
                    self.clear()
                plain = word[:-1] if len(word) > 3 and word.endswith("s") else word
                # 0 ends a sentence, 1 is a word too short to count.
                n = self[word] = 0 if word in ".!?" else 1 if len(plain) < 3 else xxhash.xxh3_64_intdigest(plain) >> 1 | 2
                return n

        self.memo = Memo()

    def split(self, title: str | None, text: str | None) -> list[str]:
        """Words and marks at the end of sentences."""
        whole = f"{(title or '').translate(self.marks)} . {text or ''}".lower()
        return self.tokens(self.markup.sub(" ", whole) if "<" in whole or "&" in whole else whole)

    def batch(self, titles: list[str | None], texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words: list[str] = []
        ends = []
        for title, text in zip(titles, texts):
            words += self.split(title, text)
            ends.append(len(words))
        ids = np.fromiter(map(self.memo.__getitem__, words), dtype="int64", count=len(words))
        lengths = np.diff(np.asarray(ends, dtype="int64"), prepend=0)
        document = np.repeat(np.arange(len(lengths)), lengths)
        stops = np.cumsum(ids == 0)
        first = np.asarray(ends, dtype="int64") - lengths
        before = np.where(first > 0, stops[np.maximum(first - 1, 0)], 0) if len(words) else first
        sentence = np.minimum(stops - np.repeat(before, lengths), _LAST)
        long = ids > 1
        return ids[long], document[long], sentence[long]


def _without(stop: np.ndarray, ids: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    at = np.minimum(np.searchsorted(stop, ids), max(len(stop) - 1, 0))
    keep = stop[at] != ids if len(stop) else np.ones(len(ids), dtype=bool)
    return ids[keep], *(x[keep] for x in others)


def word_counts(documents: DataFrame, title: str, text: str) -> DataFrame:
    """``word`` and ``n``, the documents that have it (one with two forms of a word counts for both); the row of word 0 counts all documents. Counted in the task, then added up."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows = Words(), 0
        seen: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            ids = np.fromiter(map(words.memo.__getitem__, seen), dtype="int64", count=len(seen))
            n = np.fromiter(seen.values(), dtype="int64", count=len(seen))
            return pa.RecordBatch.from_arrays([pa.array(np.r_[0, ids[ids > 1]]), pa.array(np.r_[rows, n[ids > 1]])], names=["word", "n"])

        for batch in batches:
            for title, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen.update(set(words.split(title, text)))
            rows += batch.num_rows
            if len(seen) >= MEMO:
                yield flushed()
                rows = 0
                seen.clear()
        yield flushed()

    return documents.select(title, text).mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def passages(documents: DataFrame, title: str, text: str, stop) -> DataFrame:
    """The other columns and ``_words``: per sentence a mark, -1 less its number, and its words in order, stop words left out."""
    kept = [c for c in documents.columns if c not in (title, text)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            ids, document, sentence = _without(stop.value, *words.batch(batch.column(title).to_pylist(), batch.column(text).to_pylist()))
            starts = np.flatnonzero(np.r_[True, (np.diff(document) != 0) | (np.diff(sentence) != 0)]) if len(ids) else np.zeros(0, dtype="int64")
            flat = np.insert(ids, starts, -1 - sentence[starts])
            ends = np.searchsorted(np.insert(document, starts, document[starts]), np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, "_words"])

    return documents.mapInArrow(read, T.StructType([*[documents.schema[c] for c in kept], T.StructField("_words", T.ArrayType(T.LongType()))]))


def _unpacked(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, documents and sentences of ``_words``."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    document = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
    word = flat > 0
    at = np.maximum.accumulate(np.where(word, 0, np.arange(len(flat)))) if len(flat) else np.zeros(0, dtype="int64")
    return flat[word], document[word], (-1 - flat[at])[word]


def pair_counts(read: DataFrame) -> DataFrame:
    """``a`` < ``b`` and ``n``: pairs of words that follow each other in a sentence of ``_words``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, document, sentence = _unpacked(batch.column(0))
            both = (document[:-1] == document[1:]) & (sentence[:-1] == sentence[1:]) & (ids[:-1] != ids[1:])
            a, b = np.minimum(ids[:-1], ids[1:])[both], np.maximum(ids[:-1], ids[1:])[both]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(b) != 0)]) if len(a) else np.zeros(0, dtype="int64")
            n = np.diff(np.r_[starts, len(a)])
            yield pa.RecordBatch.from_arrays([pa.array(a[starts]), pa.array(b[starts]), pa.array(n)], names=["a", "b", "n"])

    return read.select("_words").mapInArrow(counted, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def representatives(counts: DataFrame, pairs: DataFrame, least: int) -> DataFrame:
    """Nodes of the graph per word: ``word``, ``mate``, ``together`` (node of the pair), ``alone`` (node of the word).

    The representative of a word is the pair it is most often in; words and pairs of fewer than ``least`` occurrences are none.
    """
    node = lambda *c: F.xxhash64(*c).bitwiseAND(F.lit(_MASK))
    often = pairs.where(F.col("n") >= least)
    ends = often.select("n", F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("mate")), F.struct(F.col("b").alias("word"), F.col("a").alias("mate")))).alias("_e")).select("_e.*", "n")
    best = ends.groupBy("word").agg(F.max_by("mate", F.struct("n", "mate")).alias("mate"))
    joined = counts.where(F.col("n") >= least).select("word").join(best, "word", "left")
    together = F.when(F.col("mate").isNotNull(), node(F.least("word", "mate"), F.greatest("word", "mate"), F.lit(1)))
    return joined.select("word", "mate", together.alias("together"), node(F.col("word")).alias("alone"))


def node_subjects(counts: DataFrame, *, least: float = 2.5, purity: float = 0.5) -> DataFrame:
    """Verified nodes: those whose documents' labels agree. In: ``node``, ``subject``, ``n``; out: ``node``, ``subject``, ``weight``.

    The share of a node's leading subject, less one standard deviation of its estimate, must exceed by ``purity`` what the
    subject's share of all labels gives by chance (0 at chance, 1 at full agreement). So a subject that
    only has stray labels verifies nothing, and a node that says nothing about the subject links nothing.
    """
    total = counts.groupBy("subject").agg(F.sum("n").alias("_all"))
    base = total.join(total.agg(F.sum("_all").alias("_sum")), how="cross").select("subject", (F.col("_all") / F.col("_sum")).alias("_base"))  # one row beside one row per subject
    sums = counts.groupBy("node").agg(F.sum("n").alias("_n"), F.max(F.struct("n", "subject")).alias("_top"))
    share = F.col("_top.n") / F.col("_n")
    bound = (share + 1 / (2 * F.col("_n")) - F.sqrt(share * (1 - share) / F.col("_n") + 1 / (4 * F.col("_n") * F.col("_n")))) / (1 + 1 / F.col("_n"))
    led = sums.where(F.col("_n") >= least).select("node", F.col("_top.subject").alias("subject"), bound.alias("_bound")).join(base, "subject")
    weight = (F.col("_bound") - F.col("_base")) / F.greatest(1 - F.col("_base"), F.lit(1e-6))
    return led.withColumn("weight", weight).where(F.col("weight") >= purity).select("node", "subject", "weight")


def _linked_in_task(read: DataFrame, known: DataFrame) -> DataFrame:
    """``_linked`` for numbered nodes of checked number: the table of words (32 bytes a word) goes to the tasks."""
    table = known.toArrow().sort_by("word")
    word = table.column("word").to_numpy()
    mate = table.column("mate").fill_null(-1).to_numpy()
    at = np.minimum(np.searchsorted(word, mate), max(len(word) - 1, 0))
    mate = np.where(word[at] == mate, at, -1) if len(word) else mate
    shared = read.sparkSession.sparkContext.broadcast((word, mate, table.column("together").fill_null(-1).to_numpy(), table.column("alone").to_numpy()))
    kept = [c for c in read.columns if c != "_words"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, mate, together, alone = shared.value
        for batch in batches:
            ids, document, sentence = _unpacked(batch.column("_words"))
            at = np.minimum(np.searchsorted(word, ids), max(len(word) - 1, 0))
            hit = word[at] == ids if len(word) else np.zeros(len(ids), dtype=bool)
            at, document, sentence = at[hit], document[hit], sentence[hit]
            place = np.cumsum(np.r_[False, (np.diff(document) != 0) | (np.diff(sentence) != 0)]) if len(at) else at
            held = np.unique((place << 32) + at)
            other = (place << 32) + mate[at]
            found = np.minimum(np.searchsorted(held, other), max(len(held) - 1, 0))
            both = (held[found] == other) & (mate[at] >= 0) if len(held) else np.zeros(0, dtype=bool)
            links = (sentence << _SHIFT) + np.where(both, together[at], alone[at])
            order = np.lexsort((links, document))
            links, document = links[order], document[order]
            new = np.r_[True, (np.diff(links) != 0) | (np.diff(document) != 0)] if len(links) else np.zeros(0, dtype=bool)
            ends = np.searchsorted(document[new], np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(links[new], type=pa.int64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], lists], names=[*kept, "_links"])

    return read.mapInArrow(link, T.StructType([*[read.schema[c] for c in kept], T.StructField("_links", T.ArrayType(T.LongType()))]))


def _linked(read: DataFrame, known: DataFrame) -> DataFrame:
    """The other columns and ``_links``: each sentence's words joined with the representatives, the mate verified to be in the sentence."""
    element = T.StructType([T.StructField("pos", T.LongType()), T.StructField("words", T.ArrayType(T.LongType()))])

    def nest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, document, sentence = _unpacked(batch.column("_words"))
            starts = np.flatnonzero(np.r_[True, (np.diff(document) != 0) | (np.diff(sentence) != 0)]) if len(ids) else np.zeros(0, dtype="int64")
            inner = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(ids)], type=pa.int32()), pa.array(ids))
            structs = pa.StructArray.from_arrays([pa.array(sentence[starts]), inner], names=["pos", "words"])
            ends = np.searchsorted(document[starts], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), structs)], names=[*batch.schema.names, "_p"])

    nested = read.mapInArrow(nest, T.StructType([*read.schema, T.StructField("_p", T.ArrayType(element))]))
    one = nested.select("_id", "_v", "_hint", F.explode_outer("_p").alias("_p"))
    spread = one.select("_id", "_v", "_hint", F.col("_p.pos").alias("_pos"), F.col("_p.words").alias("_words"), F.explode_outer("_p.words").alias("word"))
    joined = spread.withColumn("_salt", salt_of(["_id"], 16)).join(replicate(known, 16), ["word", "_salt"], "left")
    node = F.when(F.array_contains("_words", F.col("mate")), F.col("together")).otherwise(F.col("alone"))
    return joined.groupBy("_id", "_v").agg(F.max("_hint").alias("_hint"), F.collect_set(F.shiftleft("_pos", _SHIFT) + node).alias("_links"))


def _looked_up(incidence: DataFrame, n_nodes: int, labels: DataFrame) -> DataFrame:
    """``_read`` for numbered nodes of checked number: the table of labels (16 bytes a node) goes to the tasks, links stay where they are."""
    table = labels.toArrow()
    names = sorted(set(table.column("subject").to_pylist()))
    code, weight = np.full(n_nodes, -1, dtype="int32"), np.zeros(n_nodes)
    at = table.column("node").to_numpy()
    code[at] = pa.compute.index_in(table.column("subject"), pa.array(names, type=pa.string())).to_numpy()
    weight[at] = np.round(table.column("weight").to_numpy(), 6)
    shared = incidence.sparkSession.sparkContext.broadcast((code, weight, names))
    element = T.StructType([T.StructField("subject", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("n_text", T.IntegerType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, weight, names = shared.value
        named = pa.array(names, type=pa.string())
        for batch in batches:
            lists = batch.column("_links")
            links, lengths = lists.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            document, node = np.repeat(np.arange(len(lengths)), lengths), links & _MASK
            keep = code[node] >= 0 if len(code) else np.zeros(len(links), dtype=bool)
            document, node, sentence = document[keep], node[keep], links[keep] >> _SHIFT
            order = np.lexsort((code[node], weight[node], sentence, document))
            document, subject, sentence = document[order], code[node][order], sentence[order]
            last = np.flatnonzero(np.r_[(np.diff(document) != 0) | (np.diff(sentence) != 0), True]) if len(document) else np.zeros(0, dtype="int64")
            document, subject, in_text = document[last], subject[last], (sentence[last] > 0).astype("int32")
            order = np.lexsort((subject, document))
            document, subject, in_text = document[order], subject[order], in_text[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(document) != 0) | (np.diff(subject) != 0)]) if len(document) else np.zeros(0, dtype="int64")
            n = np.diff(np.r_[starts, len(document)]).astype("int32")
            n_text = np.add.reduceat(in_text, starts).astype("int32") if len(starts) else n
            structs = pa.StructArray.from_arrays([named.take(pa.array(subject[starts])), pa.array(n), pa.array(n_text)], names=["subject", "n", "n_text"])
            ends = np.searchsorted(document[starts], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), structs)], names=[*batch.schema.names, "_r"])

    return incidence.mapInArrow(read, T.StructType([*incidence.schema, T.StructField("_r", T.ArrayType(element))]))


def _read(incidence: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds ``_r``: per subject of a document the sentences whose weightiest node has it (``n``), and those of the text (``n_text``).

    Of equal nodes of a sentence the subject last by name counts.
    """
    links = incidence.select("_id", F.explode("_links").alias("_k")).select("_id", F.shiftright("_k", _SHIFT).alias("pos"), F.col("_k").bitwiseAND(F.lit(_MASK)).alias("node"))
    salted = links.withColumn("_salt", salt_of(["_id"], 16)).join(replicate(labels, 16), ["node", "_salt"])
    tops = salted.groupBy("_id", "pos").agg(F.max(F.struct(F.round("weight", 6), "subject")).alias("_top"))
    counted = tops.groupBy("_id", F.col("_top.subject").alias("subject")).agg(F.count(F.lit(1)).cast("int").alias("n"), F.count_if(F.col("pos") > 0).cast("int").alias("n_text"))
    lists = counted.groupBy("_id").agg(F.collect_list(F.struct("subject", "n", "n_text")).alias("_r"))
    return incidence.join(lists, "_id", "left").withColumn("_r", F.coalesce("_r", F.array()))


def propagate_subjects(
    documents: DataFrame, seeds: DataFrame | None = None, hints: DataFrame | None = None, *, id_col: str = "id", title: str = "title", text: str = "text", hint: str = "hint", order: str | None = None, rounds: int = 20,
    tolerance: float = 0.01, most: float = 0.05, least: int = 3, purity_first: float = 0.3, purity: float = 0.5, seed_weight: float = 5.0, broadcast_nodes: int = BROADCAST_NODES,
) -> DataFrame:
    """Subjects of each document: ``id_col``, ``subject``, ``n_sentences`` (the title is one), ``n_text`` (sentences of the text), ``share`` (of the text's sentences that count), ``trusted``.

    The graph joins documents by similar passages. Candidates are blocked by word: each word has a representative,
    the pair of words it is most often in, and a sentence with the word is linked to it if the whole pair is
    verified to be in the sentence; if not, to the word alone. Documents with a link in common are neighbours. As all
    are linked to representatives and not to each other, a word of a third of all documents makes no pairs.
    Words of more than ``most`` of the documents link nothing. The graph has words and pairs of all documents, with or without a hint.

    Labels start from ``hint`` (a column of ``documents``, may be null or wrong), else from ``hints`` (``id_col``, ``subject``). A round takes them
    from documents to nodes (explode, aggregate by node and subject), verifies that the documents of a node agree
    (``node_subjects``), and takes them from nodes back to documents by a join, each sentence taking its weightiest subject. Hints are often wrong,
    so the first check is mild (``purity_first``), those on propagated labels stricter (``purity``). Rounds end when
    no more than ``tolerance`` of the verified nodes change their subject, come or go; that they do not within ``rounds`` is an error.
    ``seeds`` (``id_col``, ``subject``) are trusted: they are clamped in every round, with ``seed_weight``, and in the result, where they
    are marked ``trusted``. Documents keep all subjects that their sentences have, by share.

    Of rows with one id the greatest by ``order`` counts (null is least). Null titles and texts
    are empty; a document without words that others have gets no row. ``OUTSIDE`` is a label like any other.
    """
    spark = documents.sparkSession
    version = F.struct(*([F.col(order).alias("o")] if order else []), F.xxhash64(title, text).alias("h"))
    rows = documents.select(F.col(id_col).alias("_id"), version.alias("_v"), F.col(hint).alias("_hint"), F.col(title).alias("_title"), F.col(text).alias("_text"))

    counts = cut(word_counts(rows, "_title", "_text").where(F.col("n") >= least))
    n_rows = counts.where("word = 0").agg(F.max("n")).first()[0] or 0
    # At most 1/``most`` times the mean number of different words of a document.
    frequent = counts.where((F.col("word") != 0) & (F.col("n") > most * n_rows) & (F.col("n") > least)).select("word").toArrow().column("word").to_numpy()
    stop = spark.sparkContext.broadcast(np.sort(frequent))
    read = cut(passages(rows, "_title", "_text", stop))
    known = cut(representatives(counts.where((F.col("word") != 0) & ~((F.col("n") > most * n_rows) & (F.col("n") > least))), pair_counts(read), least))
    nodes = known.select(F.explode(F.array("together", "alone")).alias("node")).where("node IS NOT NULL").distinct()
    n_nodes = nodes.count()
    few = n_nodes <= broadcast_nodes
    if few:
        # No more than broadcast_nodes rows.
        numbers = cut(nodes.select("node", (F.row_number().over(W.orderBy("node")) - 1).cast("long").alias("_at")))
        renamed = lambda c: numbers.select(F.col("node").alias(c), F.col("_at").alias(f"_{c}"))
        known = known.join(renamed("alone"), "alone").join(renamed("together"), "together", "left").select("word", "mate", F.col("_together").alias("together"), F.col("_alone").alias("alone"))
        versions = _linked_in_task(read, known)
    else:
        versions = _linked(read, known)
    none = F.lit(None).cast("string")
    versions = versions.select("_id", "_v", "_links", none.alias("_seed"), "_hint", none.alias("_other"))
    nothing = [F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in ("_v", "_links")]
    if seeds is not None:
        versions = versions.unionByName(seeds.select(F.col(id_col).alias("_id"), *nothing, F.col("subject").alias("_seed"), none.alias("_hint"), none.alias("_other")))
    if hints is not None:
        versions = versions.unionByName(hints.select(F.col(id_col).alias("_id"), *nothing, none.alias("_seed"), none.alias("_hint"), F.col("subject").alias("_other")))
    # Only links, no texts, are shuffled; rows of one id are reduced before it as well.
    read_hint = F.coalesce(F.max_by("_hint", F.when(F.col("_hint").isNotNull(), F.col("_v"))), F.min("_other"))
    incidence = cut(versions.groupBy("_id").agg(F.max_by("_links", "_v").alias("_links"), F.min("_seed").alias("_seed"), read_hint.alias("_hint")).where("_links IS NOT NULL AND _id IS NOT NULL"))
    seen = lambda labels: _looked_up(incidence, n_nodes, labels) if few else _read(incidence, labels)
    one = lambda c, w: F.array(F.struct(c.alias("subject"), F.lit(w).alias("n")))

    def verified(labelled: DataFrame, least: float, purity: float) -> DataFrame:
        own = labelled.select(F.array_distinct(F.transform("_links", lambda x: x.bitwiseAND(F.lit(_MASK)))).alias("_links"), "_l")
        pairs = own.select("_links", F.explode("_l").alias("_l")).select(F.explode("_links").alias("node"), "_l.subject", "_l.n")
        return cut(node_subjects(pairs.groupBy("node", "subject").agg(F.sum("n").alias("n")), least=least, purity=purity))

    labels = verified(incidence.select("_links", F.coalesce(F.when(F.col("_seed").isNotNull(), one(F.col("_seed"), seed_weight)), F.when(F.col("_hint").isNotNull(), one(F.col("_hint"), 1.0))).alias("_l")).where("_l IS NOT NULL"), least + 0.5, purity_first)
    for _ in range(rounds):
        got = seen(labels)
        total = F.aggregate("_r", F.lit(0), lambda s, x: s + x["n"])
        own = F.transform("_r", lambda x: F.struct(x["subject"].alias("subject"), (x["n"] / total).alias("n")))
        before, labels = labels, verified(got.select("_links", F.when(F.col("_seed").isNotNull(), one(F.col("_seed"), seed_weight)).otherwise(own).alias("_l")), 2.5, purity)
        both = before.select("node", F.col("subject").alias("_old")).join(labels, "node", "full")
        changed, size = both.agg(F.count_if(~F.col("_old").eqNullSafe(F.col("subject"))), F.count("subject")).first()
        if changed <= tolerance * size:
            break
    else:
        raise ValueError(f"labels do not settle in {rounds} rounds")
    got = seen(labels)
    clamped = F.when(F.col("_seed").isNull() | F.exists("_r", lambda x: x["subject"] == F.col("_seed")), F.col("_r")).otherwise(F.concat("_r", F.array(F.struct(F.col("_seed").alias("subject"), F.lit(0).alias("n"), F.lit(0).alias("n_text")))))
    got = got.select("_id", "_seed", F.aggregate("_r", F.lit(0), lambda s, x: s + x["n_text"]).alias("_total"), F.explode(clamped).alias("_r"))
    return got.select(F.col("_id").alias(id_col), "_r.subject", F.col("_r.n").alias("n_sentences"), F.col("_r.n_text").alias("n_text"), (F.col("_r.n_text") / F.nullif(F.col("_total"), F.lit(0))).alias("share"), (F.col("_r.subject") == F.col("_seed")).eqNullSafe(F.lit(True)).alias("trusted"))


def chosen_subjects(found: DataFrame, *, id_col: str = "id", least_sentences: int = 2, least_share: float = 0.2) -> DataFrame:
    """The subjects that a document deals with: the leading one and others with a good part of the text.

    The leading one has the most sentences, of equals the title's. It is kept however short the text is, unless
    it is ``OUTSIDE``. A further subject with a single sentence is a mention in passing; one sentence beside the
    title is enough. Rows marked ``trusted`` (if there is such a column) are kept in any case.
    """
    of_title = F.col("n_sentences") > F.col("n_text")
    lead = F.max(F.struct("n_sentences", of_title.alias("_title"), "subject")).over(W.partitionBy(id_col))
    good = (F.col("n_sentences") >= least_sentences) & (F.col("n_text") > 0) & (F.col("share") >= least_share)
    kept = good | (F.col("subject") == F.col("_lead.subject"))
    kept = kept | F.col("trusted") if "trusted" in found.columns else kept
    return found.withColumn("_lead", lead).where((F.col("subject") != OUTSIDE) & kept).drop("_lead")
