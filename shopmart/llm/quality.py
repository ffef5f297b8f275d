"""Quality classifier: perplexity under a modified Kneser-Ney character model.

An interpolated n-gram model (``ORDER`` characters, discounts for counts of 1, 2 and
more, estimated from counts of counts) is trained on the texts that labels call good.
Its tables are made by joins of counts: n-grams with their contexts, and with the
probabilities of their suffixes. A row of the model holds an n-gram, its log probability
and the weight with which it, as a context, backs off.

Scoring joins shards of the model with blocks of documents. A scan task cuts its documents into
blocks and asks, once per block, for each distinct n-gram; requests and model meet in a
join on the n-gram; answers return to one file per block in the shared folder; a second
scan cuts the same blocks, finds its answers by a digest of the block's texts and sums
them per document. Documents are never shuffled, and each n-gram travels once per block.
A block that finds no answers (the table changed between the scans) raises.

A document is rejected if its perplexity is over a quantile of trusted
documents' perplexities in its language, times a margin. A model knows its own training
texts too well, so half of the trusted documents, by a hash of the id, train it and the other
half set the quantiles. Languages without such documents use the quantile over all of them.
Perplexities of short texts vary by chance: ``PRIOR`` characters of average text are added to each.

Ids may be of any type and are matched to labels as text. Nulls: a null or empty text has no perplexity and is kept, like a document without an
id; a null language is a language. Of labels that repeat an id, the worst counts; of rows that repeat one each is judged by its own text. Without
trusted documents all are kept.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmart.llm.common import bitmap, bitmap_place, in_bitmap, new_folder, open_folder, stored, tidy
from shopmart.llm.tokens import text_slices

ORDER = 4  # characters of 16 bits: an n-gram is a 64-bit number
BLOCK_CHARS = 12_000_000
CHUNK_CHARS = 500_000
QUANTILE = 0.99
MARGIN = 1.08
PRIOR = 400


def _characters(text: str) -> np.ndarray:
    """Code points, those beyond 16 bits as one, behind ``ORDER - 1`` line ends."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.concatenate([np.full(ORDER - 1, 10, np.uint64), np.minimum(points, 0xFFFF)]).astype(np.uint64)


def _grams(text: str) -> np.ndarray:
    """The n-gram that ends in each character of a text."""
    c = _characters(text)
    n = len(c) - ORDER + 1
    key = c[:n]
    for k in range(1, ORDER):
        key = key << np.uint64(16) | c[k : k + n]
    return key


def _suffix(key: np.ndarray, k: int) -> np.ndarray:
    return key & np.uint64((1 << 16 * k) - 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list, list[str]]]:
    """Name, rows (all columns but the last) and texts of each block; the last column is the text."""
    digest, rows, texts, held = xxhash.xxh3_128(), [], [], 0
    for batch in batches:
        for a, b in text_slices(batch.column(batch.num_columns - 1)):
            columns = [c.to_pylist() for c in batch.slice(a, b - a).columns]
            for *row, text in zip(*columns, strict=True):
                text = text or ""
                if rows and held + len(text) > BLOCK_CHARS:
                    yield digest.hexdigest(), rows, texts
                    digest, rows, texts, held = xxhash.xxh3_128(), [], [], 0
                digest.update(f"{len(text)} ".encode() + text.encode("utf-8", "surrogatepass"))
                rows.append(row)
                texts.append(text)
                held += len(text)
    if rows:
        yield digest.hexdigest(), rows, texts


def _chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """N-grams of about ``CHUNK_CHARS`` characters at a time, and each text's number of them."""
    grams: list[np.ndarray] = []
    held = 0
    for text in texts:
        grams.append(_grams(text))
        held += len(text)
        if held >= CHUNK_CHARS:
            yield np.concatenate(grams), np.array([len(g) for g in grams])
            grams, held = [], 0
    if grams:
        yield np.concatenate(grams), np.array([len(g) for g in grams])


def trains(key: Column) -> Column:
    """Whether a trusted document trains the model; else it sets quantiles."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("fold")), F.lit(2)) == 0


def trusted_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Texts of documents whose labels say quality 1, of the half that trains.

    Before the join, documents that surely have no such label are left out by a bitmap of
    hashed ids, of 1 MB whatever the size of the tables.
    """
    good = labels.groupBy(F.col("doc_id").cast("string").alias("id")).agg(F.min("quality").alias("q"))
    good = good.where("q = 1 and id is not null").where(trains(F.col("id")))
    good = stored(good.select("id"), "trusted-ids")
    known = bitmap(good, "id")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = in_bitmap(known, batch.column("place").to_numpy())
            yield batch.filter(pa.array(some)).select(["id", "text"])

    source = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")
    ).where("id is not null")
    placed = source.select("id", bitmap_place("id").alias("place"), "text")
    some = placed.mapInArrow(tidy(likely), "id string, text string")
    return some.join(good, "id").select("text")


def _counted(texts: DataFrame) -> DataFrame:
    """N-grams of the highest order and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, texts in _blocks(batches):
            found = [np.unique(keys, return_counts=True) for keys, _ in _chunks(texts)]
            keys, place = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, place, np.concatenate([n for _, n in found]))
            columns = [pa.array(keys.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["gram", "n"])

    return texts.mapInArrow(tidy(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more, from counts of counts; none for no counts."""
    rows = grams.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("m")).collect()
    m = {r.n: r.m for r in rows}
    if not all(m.get(k) for k in (1, 2, 3, 4)):
        return [0.0, 0.5, 0.75, 0.9]  # too little text for estimates
    y = m[1] / (m[1] + 2 * m[2])
    found = [k - (k + 1) * y * m[k + 1] / m[k] for k in (1, 2, 3)]
    return [0.0, *(min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), found, strict=True))]


def train(texts: DataFrame) -> DataFrame:
    """The model: ``k``, ``gram`` (of k characters), ``logp``, ``backoff``.

    A row with k 0 holds the log probability of a character that was never seen.
    """
    tables = {ORDER: stored(_counted(texts), f"grams-{ORDER}")}
    for k in range(ORDER - 1, 0, -1):
        # How many different characters precede: continuation counts.
        suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1))
        counted = tables[k + 1].groupBy(suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        tables[k] = stored(counted, f"grams-{k}")
    lower, parts = None, []
    for k in range(1, ORDER + 1):
        d = _discounts(tables[k])
        less = F.when(F.col("n") == 1, d[1]).when(F.col("n") == 2, d[2]).otherwise(d[3])
        context = F.shiftrightunsigned("gram", 16).alias("context")
        grams = tables[k].select("gram", "n", context, less.alias("less"))
        contexts = grams.groupBy("context").agg(
            F.sum("n").alias("total"), F.sum("less").alias("given")
        )
        contexts = stored(contexts, f"contexts-{k}")
        joined = grams.join(contexts, "context")
        own, share = (F.col("n") - F.col("less")) / F.col("total"), F.col("given") / F.col("total")
        if lower is None:
            seen = tables[1].count()
            first = contexts.first()
            none = first["given"] / first["total"] / (seen + 1) if first else 1.0
            unseen = F.lit(float(np.log(none)))
            joined = joined.withColumn("p", own + none)
        else:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1))
            below = lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            joined = joined.withColumn("suffix", suffix).join(below, "suffix")
            joined = joined.withColumn("p", own + share * F.col("below"))
            # The weights of this order belong to the contexts, n-grams of the order below.
            weights = contexts.select(
                F.col("context").alias("gram"), F.log(F.col("given") / F.col("total")).alias("backoff")
            )
            # The beginnings of texts are contexts that end no longer n-gram.
            parts.append(_part(k - 1, lower.join(weights, "gram", "full")))
        lower = stored(joined.select("gram", "p"), f"probabilities-{k}")
    parts.append(_part(ORDER, lower.withColumn("backoff", F.lit(0.0))))
    spark = texts.sparkSession
    none_seen = [F.lit(0).alias("k"), F.lit(0).cast("long").alias("gram"), unseen.alias("logp")]
    parts.append(spark.range(1).select(*none_seen, F.lit(0.0).alias("backoff")))
    model = parts[0]
    for part in parts[1:]:
        model = model.unionByName(part)
    return stored(model, "language-model")


def _part(k: int, df: DataFrame) -> DataFrame:
    backoff = F.coalesce("backoff", F.lit(0.0)).alias("backoff")
    logp = F.coalesce(F.log("p"), F.lit(float("nan"))).alias("logp")  # none for a mere context
    return df.select(F.lit(k).alias("k"), "gram", logp, backoff)


def _find(keys: np.ndarray, table: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted table, and whether they are there."""
    if not len(table[0]):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return at, table[0][at] == keys


def _log_probabilities(keys: np.ndarray, tables: dict[int, tuple[np.ndarray, ...]]) -> np.ndarray:
    """Of each n-gram's last character, by the longest seen n-gram and weights of seen contexts."""
    total = np.full(len(keys), tables[0][1][0] if len(tables[0][0]) else 0.0)
    for k in range(1, ORDER + 1):
        own = _suffix(keys, k)
        if k > 1:
            at, seen = _find(own >> np.uint64(16), tables[k - 1])
            total = total + np.where(seen, tables[k - 1][2][at] if len(tables[k - 1][2]) else 0.0, 0.0)
        at, seen = _find(own, tables[k])
        if len(tables[k][0]):
            logp = tables[k][1][at]
            total = np.where(seen & ~np.isnan(logp), logp, total)
    return total


def score(
    docs: DataFrame, model: DataFrame, columns: list[str], text_col: str = "text"
) -> DataFrame:
    """``columns`` of every document with ``n_scored`` characters and their ``log_probability``."""
    folder = new_folder(docs.sparkSession, "answers")
    source = docs.select(*columns, F.col(text_col).cast("string").alias("__text"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in _blocks(batches):
            keys = np.unique(np.concatenate([np.unique(keys) for keys, _ in _chunks(texts)]))
            asked = [(0, np.zeros(1, np.uint64))]
            for k in range(ORDER, 0, -1):
                asked.append((k, keys))
                # Contexts are n-grams of the same text, but for the first k characters.
                keys = np.unique(np.concatenate([_suffix(keys, k - 1), keys >> np.uint64(16)]))
            k = np.concatenate([np.full(len(x), k, np.int32) for k, x in asked])
            gram = np.concatenate([x for _, x in asked]).view(np.int64)
            block = pa.array([name]).take(pa.array(np.zeros(len(k), np.int8)))
            yield pa.RecordBatch.from_arrays([block, pa.array(k), pa.array(gram)], ["block", "k", "gram"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)

        def write(name: str, parts: list[pa.RecordBatch]) -> None:
            whole = pa.Table.from_batches(parts)
            out = io.BytesIO()
            np.savez(out, *(whole.column(c).to_numpy() for c in ("k", "gram", "logp", "backoff")))
            with files.open_output_stream(f"{base}/{name}") as stream:
                stream.write(out.getvalue())

        held: list[pa.RecordBatch] = []
        current, n = None, 0
        for batch in batches:
            names = batch.column("block").dictionary_encode()
            codes = names.indices.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                name = names[a].as_py()
                if name != current and held:
                    write(current, held)
                    held, n = [], n + 1
                current = name
                held.append(batch.slice(a, b - a))
        if held:
            write(current, held)
            n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        kinds = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kinds
            for batch in batches:
                kinds = batch.schema
                yield batch

        for name, rows, texts in _blocks(typed()):
            with files.open_input_stream(f"{base}/{name}") as stream:
                k, gram, logp, backoff = np.load(io.BytesIO(stream.read())).values()
            gram = gram.view(np.uint64)
            tables = {}
            for order in range(ORDER + 1):
                own = np.flatnonzero(k == order)
                own = own[np.argsort(gram[own], kind="stable")]
                tables[order] = (gram[own], logp[own], backoff[own])
            each_size, each_sum = [], []
            for keys, sizes in _chunks(texts):
                distinct, place = np.unique(keys, return_inverse=True)
                values = _log_probabilities(distinct, tables)[place]
                sums = np.zeros(len(sizes))
                used = np.flatnonzero(sizes)
                if len(used):
                    sums[used] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[used])
                each_size.append(sizes)
                each_sum.append(sums)
            sizes, sums = np.concatenate(each_size), np.concatenate(each_sum)
            fields = [kinds.field(i) for i in range(len(columns))]
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sizes, pa.int64()), pa.array(sums)],
                [*columns, "n_scored", "log_probability"],
            )

    files, base = open_folder(folder)
    files.create_dir(base, recursive=True)
    asked = source.mapInArrow(tidy(ask), "block string, k int, gram long")
    found = asked.join(model, ["k", "gram"]).select("block", "k", "gram", "logp", "backoff")
    by_block = found.repartition("block").sortWithinPartitions("block")
    by_block.mapInArrow(tidy(answer), "n long").agg(F.sum("n")).collect()
    schema = docs.select(*columns).schema.add("n_scored", "long").add("log_probability", "double")
    return source.mapInArrow(tidy(add), schema)


def _surprise(mean: float) -> Column:
    """Mean negative log probability of a character, with ``PRIOR`` average ones added."""
    total = -F.col("log_probability") + F.lit(PRIOR * mean)
    return F.when(F.col("n_scored") > 0, total / (F.col("n_scored") + PRIOR))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Id, language, ``perplexity``, ``threshold`` and ``is_kept`` of every document."""
    judged = _judged(docs, labels, quantile, margin, id_col, text_col, lang_col, F.lit(None).cast("string"))
    return judged.select(
        F.col("id").alias(id_col), F.col("lang").alias(lang_col), "perplexity", "threshold", "is_kept"
    )


def _judged(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float,
    margin: float,
    id_col: str,
    text_col: str,
    lang_col: str,
    digest: Column,
) -> DataFrame:
    """What ``classify`` returns, with a digest of each row's text, under names of its own."""
    # Stored, so that no task runs two Python steps: each would need a worker of its own, which stays.
    trusted = stored(trusted_documents(docs, labels, id_col, text_col), "trusted-texts")
    model = train(trusted)
    scored = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).alias("lang"),
        digest.alias("digest"),
        F.col(text_col).alias("text"),
    )
    scored = stored(score(scored, model, ["id", "lang", "digest"]), "scored")
    good = labels.groupBy(F.col("doc_id").cast("string").alias("key")).agg(F.min("quality").alias("q"))
    held_out = good.where("q = 1").where(~trains(F.col("key"))).select("key")
    keyed = scored.where("n_scored > 0").withColumn("key", F.col("id").cast("string"))
    trusted = stored(keyed.join(held_out, "key", "left_semi"), "scored-trusted")
    total = trusted.agg(F.sum("log_probability").alias("s"), F.sum("n_scored").alias("n")).first()
    mean = -total.s / total.n if total.n else 0.0
    at = F.percentile_approx(_surprise(mean), F.lit(quantile), F.lit(10_000))
    limits = trusted.groupBy("lang").agg(at.alias("own_limit"))
    overall = trusted.agg(at.alias("x")).first().x
    limit = F.exp(F.coalesce("own_limit", F.lit(overall).cast("double"))) * margin
    perplexity = F.exp(_surprise(mean))
    joined = scored.join(
        limits.withColumnRenamed("lang", "__lang"), F.col("lang").eqNullSafe(F.col("__lang")), "left"
    )
    kept = F.coalesce(perplexity <= limit, F.lit(True)) | F.col("id").isNull()
    return joined.select(
        "id",
        "lang",
        "digest",
        perplexity.alias("perplexity"),
        limit.alias("threshold"),
        kept.alias("is_kept"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``docs`` without the rejected rows: a row goes by its own id, language and text, so
    others with the same id stay."""
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    judged = _judged(docs, labels, quantile, margin, id_col, text_col, lang_col, digest)
    rejected = judged.where("not is_kept").select(F.struct("id", "lang", "digest").alias("key")).distinct()
    key = F.struct(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), digest.alias("digest"))
    rows = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"))
    return rows.join(rejected, "key", "left_anti").select("own.*")
