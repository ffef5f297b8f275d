"""Secret scans: a random forest tells secrets from other long strings.

Candidates are runs of at least ``MIN_LENGTH`` characters of keys and encodings which hold a
digit or mix cases, and every value of at least ``MIN_ASSIGNED`` characters that is assigned to a
credential's name: in quotes up to the quote in its line, else up to white space, a mark that closes a value, or the next
credential's name to which something is assigned. A candidate has at most ``MAX_LENGTH`` characters; what is longer is
cut into consecutive candidates, so nothing is left out and a text's cost is in proportion to its length. The forest sees their length, how they change between kinds of
characters, how much of them a dictionary covers, the file's path and the words beside
them. It is trained on labelled findings with ``spark.ml``; of those in documents at most
``MAX_FINDINGS`` distinct ones are used, and all reference findings. Its trees, of bounded depth and number, are then sent to the
tasks, which judge the findings that are already stored, or mask secrets in one more pass over whole texts: no join, no shuffle.

Nulls: a null text or path is an empty one; a masked null text stays null. Repeated
rows each give their findings. Empty tables give none. Without findings of both kinds there is
nothing to train on, and every candidate counts as a secret.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import string
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmart.llm.common import new_folder, stored, tidy

MIN_LENGTH = 16
MIN_ASSIGNED = 6
MAX_LENGTH = 512
MAX_FINDINGS = 20_000
TREES, DEPTH, SEED = 20, 8, 11
HASHED = 16  # columns for the words on each side

# Only from the first character of a run on, so that short runs are passed over once.
_CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}={{0,2}}")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
_BEFORE = re.compile(r"([^\W\d_]+)?\s*([:=]*)\s*([\"'`]?)$")
_AFTER = re.compile(r"^[\"'`]?\W*([^\W\d_]+)?")
_WORD = re.compile(r"[A-Za-z]{3,}")
_LETTERS = re.compile(r"[a-z]{4,}")  # dictionary words have no other characters
# What ends a value without quotes.
_ENDS = re.compile(r"[\s;&,)}\]<>\"'`]")
_SIGN = re.compile(r"[:=]")
# A name and a sign, with all around them that the pattern of assignments may take in.
_AHEAD, _BEHIND = 64, 28
# The address that a text ends within.
_ADDRESS = re.compile(r"(?:://|@)[^\s\"'<>]*$")
# Share of dictionary words from which a string counts as words.
WORDED = 0.75

# Words that name credentials, and words that name what is not in use.
CREDENTIAL_WORDS = (
    "access", "apikey", "auth", "bearer", "credential", "key", "passwd", "password", "private",
    "pwd", "secret", "session", "token",
)
_NAME = rf"(?:{'|'.join(CREDENTIAL_WORDS)})[\w\-]{{0,40}}[\"'`\]]{{0,2}}[ \t]{{0,8}}(?::=|=>|[:=])[ \t]{{0,8}}(?:(?:bearer|basic|token)[ \t]{{1,8}})?"
_ASSIGNED = re.compile(rf"{_NAME}([\"'`]?)", re.I)
_NAMED = re.compile(rf"{_NAME}[\"'`]?$", re.I)
_TAIL = "."  # what may follow a value without quotes
PLACEHOLDER_WORDS = ("changeme", "demo", "dummy", "example", "fake", "placeholder", "sample", "test")

SHAPE = [
    "length", "entropy", "digits", "upper", "lower", "changes", "hex", "repeat", "dictionary",
    "words", "credential_before", "assigned", "quoted", "placeholder", "in_address", "path_test",
    "path_code", "named", "marks", "spaces",
]


@dataclass(frozen=True)
class Candidate:
    start: int
    text: str
    features: list[float]


_KINDS = {c: "a" for c in string.ascii_lowercase} | {c: "A" for c in string.ascii_uppercase}
_KINDS = str.maketrans(_KINDS | {c: "0" for c in string.digits} | {chr(c): "." for c in range(128) if not chr(c).isalnum()})


def _kinds(text: str) -> str:
    """Each character's kind: 0 a digit, a or A a letter by its case, else a dot."""
    found = text.translate(_KINDS)
    if found.isascii():
        return found
    return "".join(
        c if c.isascii() else "0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "."
        for c in found
    )


def _slot(word: str) -> int:
    return sum(word.encode()) * 31 % HASHED


def _hashed(word: str | None) -> list[float]:
    out = [0.0] * HASHED
    if word:
        out[_slot(word.lower())] = 1.0
    return out


def _covered(text: str, dictionary: frozenset[str]) -> float:
    """Share of the characters in dictionary words of 4 to 12 letters, the longest first from the left."""
    covered = 0
    for letters in _LETTERS.findall(text.lower()):
        at, last = 0, len(letters) - 3
        while at < last:
            size = next((n for n in range(min(12, len(letters) - at), 3, -1) if letters[at : at + n] in dictionary), 0)
            covered += size
            at += size or 1
    return covered / len(text)


def features(text: str, start: int, found: str, path: str, dictionary: frozenset[str]) -> list[float]:
    """Numbers that describe a candidate, its neighbours and its file; ``SHAPE`` names the first."""
    before, after = text[max(0, start - 60) : start], text[start + len(found) : start + len(found) + 60]
    word, sign, quote = _BEFORE.search(before).groups()
    behind = _AFTER.search(after).group(1)
    n, counts = len(found), Counter(found)
    kinds = _kinds(found)
    context = (before[-40:] + found + after[:20]).lower()
    low_path = path.lower()
    shape = [
        n,
        -sum(k / n * math.log2(k / n) for k in counts.values()),
        kinds.count("0") / n,
        kinds.count("A") / n,
        kinds.count("a") / n,
        sum(map(ne, kinds, kinds[1:])) / n,
        float(not found.strip("0123456789abcdefABCDEF")),
        max(counts.values()) / n,
        _covered(found, dictionary),
        float(len(_WORD.findall(found))) / n,
        float(any(w in before[-30:].lower() for w in CREDENTIAL_WORDS)),
        float(bool(sign)),
        float(bool(quote)),
        float(any(w in context for w in PLACEHOLDER_WORDS)),
        float("://" in before[-40:] or before[-1:] in ("@", ".", "#", "?", "&")),
        float(any(w in low_path for w in PLACEHOLDER_WORDS)),
        float(bool(re.search(r"\.(py|js|ts|java|go|rb|env|cfg|ini|ya?ml|json|sh)$", low_path))),
        float(bool(_NAMED.search(text, max(0, start - 120), start))),
        sum(c in "()[]{}$<>" for c in found) / n,
        sum(c.isspace() for c in found) / n,
    ]
    return [float(x) for x in shape] + _hashed(word) + _hashed(behind)


def _assignments(text: str) -> Iterator[re.Match]:
    """Names of credentials with something assigned, sought around the signs of assignments alone."""
    stop = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < stop:
            continue  # within the stretch searched last
        start, stop = max(stop, sign.start() - _AHEAD), sign.start() + _BEHIND
        while (more := _SIGN.search(text, sign.end(), stop + _AHEAD)) and more.start() >= stop - _BEHIND:
            sign, stop = more, more.start() + _BEHIND
        yield from _ASSIGNED.finditer(text, start, stop)


def _assigned(text: str) -> Iterator[tuple[int, int]]:
    """From, to: values assigned to a credential's name."""
    found = [(m.start(), m.end(), m.group(1)) for m in _assignments(text)]
    names = [name for name, _, _ in found]
    for _, start, quote in found:
        stop = -1
        if quote:
            line = text.find("\n", start)
            stop = text.find(quote, start, len(text) if line < 0 else line)
        if stop < 0:
            # The next name that leaves a value worth a look ends this one.
            later = bisect_left(names, start + MIN_ASSIGNED)
            limit = names[later] if later < len(names) else len(text)
            end = _ENDS.search(text, start, limit)
            stop = end.start() if end else limit
            stop = start + len(text[start:stop].rstrip(_TAIL))
        if stop - start >= MIN_ASSIGNED:
            yield start, stop


def _pieces(start: int, stop: int) -> Iterator[tuple[int, int]]:
    """A span in parts of at most ``MAX_LENGTH``."""
    for at in range(start, stop, MAX_LENGTH):
        yield at, min(at + MAX_LENGTH, stop)


def candidates(text: str, path: str, dictionary: frozenset[str]) -> Iterator[Candidate]:
    """In order of their starts, the longer first; a run may lie within an assigned value."""
    spans = {m.span() for m in _CANDIDATE.finditer(text) if _MIXED.search(m.group())}
    spans = {p for span in spans.union(_assigned(text)) for p in _pieces(*span)}
    for start, stop in sorted(spans, key=lambda s: (s[0], -s[1])):
        found = text[start:stop]
        yield Candidate(start, found, features(text, start, found, path, dictionary))


def looks_assigned(text: str, start: int, found: str) -> bool:
    """A rule for labelling where none are given: a random-looking value that is
    assigned, in quotes, to a name for credentials and no placeholder."""
    word, sign, quote = _BEFORE.search(text[max(0, start - 60) : start]).groups()
    named = bool(word) and any(w in word.lower() for w in CREDENTIAL_WORDS)
    entropy = -sum(k / len(found) * math.log2(k / len(found)) for k in Counter(found).values())
    placeholder = any(w in found.lower() for w in PLACEHOLDER_WORDS)
    return named and bool(sign and quote) and entropy > 3 and not placeholder


def rule_label(found: Candidate, text: str, dictionary: frozenset[str]) -> float | None:
    """The label of a candidate as far as evidence in the text goes, otherwise None.

    1 as ``looks_assigned`` has it, but for a phrase or words. 0 is for placeholders and, where no
    credential's name is near and nothing is assigned, for addresses, numbers and words."""
    shape = dict(zip(SHAPE, found.features, strict=False))
    worded = shape["dictionary"] >= WORDED
    if any(w in found.text.lower() for w in PLACEHOLDER_WORDS):
        return 0.0
    if looks_assigned(text, found.start, found.text):
        return None if worded or any(c.isspace() for c in found.text) else 1.0
    if shape["credential_before"] or shape["assigned"]:
        return None
    end = found.start + len(found.text)
    in_address = bool(_ADDRESS.search(text[max(0, found.start - 200) : found.start])) or text[end : end + 1] == "@"
    number = not any(c.isalpha() for c in found.text)
    return 0.0 if worded or in_address or number else None


def findings(
    docs: DataFrame,
    dictionary: frozenset[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
) -> DataFrame:
    """Every candidate of every text: id, ``start`` (code points), ``candidate``, ``features`` and
    ``label`` by ``rule_label`` (null where that cannot judge), to be replaced where people have judged."""
    source = _source(docs, id_col, text_col, path_col)
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, texts, vectors, labels = [], [], [], [], []
            for key, text, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for c in candidates(text or "", path or "", dictionary):
                    keys.append(key)
                    starts.append(c.start)
                    texts.append(c.text)
                    vectors.append(c.features)
                    labels.append(rule_label(c, text, dictionary))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, batch.schema.field("id").type),
                    pa.array(starts, pa.int64()),
                    pa.array(texts, pa.string()),
                    pa.array(vectors, pa.list_(pa.float64())),
                    pa.array(labels, pa.float64()),
                ],
                [id_col, "start", "candidate", "features", "label"],
            )

    return source.mapInArrow(
        tidy(run), f"`{id_col}` {kind}, start long, candidate string, features array<double>, label double"
    )


def _source(docs: DataFrame, id_col: str, text_col: str, path_col: str) -> DataFrame:
    path = F.col(path_col).cast("string") if path_col in docs.columns else F.lit("")
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), path.alias("path")
    )


class Forest:
    """A fitted forest as arrays: for every tree feature, threshold, children and the secrets' share."""

    def __init__(self, trees: list[dict[int, tuple]]) -> None:
        self.trees = trees

    def score(self, vector: list[float]) -> float:
        """The mean over all trees of the share of secrets in the leaf that a vector falls into."""
        total = 0.0
        for tree in self.trees:
            feature, threshold, left, right, share = tree[0]
            while feature >= 0:
                place = left if vector[feature] <= threshold else right
                feature, threshold, left, right, share = tree[place]
            total += share
        return total / len(self.trees) if self.trees else 1.0


# Contexts of reference findings, with what stands in them.
SECRET_CONTEXTS = (
    ("app/settings.py", 'token = "{hex}"'), ("notes.txt", "the api key: {mixed} was"),
    ("deploy/prod.env", "AWS_SECRET_ACCESS_KEY={base64}"), ("client.js", "Authorization: Bearer {mixed}"),
    ("db.yml", 'password: "{mixed}"'), ("", "SECRET = '{base64}'!!"), ("", 'TOKEN = "{upper_hex}"!! THE'),
    ("config.json", '"private_key": "{base64}"'), ("", "auth_token={hex} and"),
    ("", 'password = "{short}"'), ("db.yml", "password: {marked}"), ("", 'secret = "{letters}"'),
    ("", "DB_PASSWORD={short}"), ("app.py", "passwd = '{marked}'"), ("", "api_key: {letters}"),
)
OTHER_CONTEXTS = (
    ("", "see https://www.example.com/en/{digits}{word}/{digits} and"), ("", "http://x.net/{word}/{word}-{word}/{digits}.html"),
    ("CHANGES.md", "commit {hex} merged"), ("lock.json", '"integrity": "sha256-{base64}"'),
    ("index.html", '<img src="data:image/png;base64,{base64}{base64}">'), ("", "the {camel} of the {camel}"),
    ("", "call {digits}{digits} now"), ("test/test_auth.py", 'token = "example-{word}-1234567890"'),
    ("README.md", 'api_key = "your-{word}-key-here-0000"'), ("", "by nt.{digits}{word}{word}@mail.example.com of"),
    ("", "the password: {word} of"), ("", 'the key = "{word} {word} {word}" of'), ("", "Token: {camel} and"),
    ("app.py", "password = get_{word}()"), ("app.py", 'token = os.environ["{word}"]'), ("", "secret: ${{{word}}}"),
    ("models.py", "id: {uuid},"), ("", "{word}{word}1{word} in {word}_{word}_{digits}"),
)
REFERENCE_ROUNDS = 25
REFERENCE_SHARE = 0.5


def _fill(template: str, k: int) -> str:
    """A context with values that follow from its number."""
    seed = hashlib.sha512(f"{template} {k}".encode())
    hexes = seed.hexdigest()
    mixed = "".join(c for c in base64.b64encode(seed.digest()).decode() if c.isalnum())
    # Syllables to make words of.
    syllables = ("the", "ing", "tion", "an", "er", "de", "la", "que", "ver", "ment", "es", "on")
    word = "".join(syllables[b % len(syllables)] for b in seed.digest()[: 3 + k % 4])
    values = {
        "hex": hexes[: (40, 32, 64)[k % 3]],
        "upper_hex": hexes[:40].upper(),
        "base64": base64.b64encode(seed.digest()[: 24 + 6 * (k % 3)]).decode(),
        "short": mixed[: 8 + k % 8],
        "marked": f"{mixed[: 3 + k % 4]}{'@!#%&*?'[k % 7]}{mixed[9 : 13 + k % 5]}{'!$^+~'[k % 5]}",
        "letters": "".join(chr(97 + b % 26) for b in seed.digest()[: 16 + k % 9]),
        "mixed": mixed[: 20 + 4 * (k % 6)],
        "digits": str(int(hexes[:16], 16))[: 8 + k % 5],
        "word": word,
        "camel": "".join(s.capitalize() for s in (word, word[::2], word)),
        "uuid": "-".join((hexes[:8], hexes[8:12], hexes[12:16], hexes[16:20], hexes[20:32])),
    }
    return template.format(**values)


def reference_findings(dictionary: frozenset[str]) -> list[tuple[list[float], float, str, int]]:
    """Labelled findings (features, label, candidate, start) in contexts of known kind, so that
    a corpus with secrets of one kind alone does not set the rule for all."""
    out = []
    for label, contexts in ((1.0, SECRET_CONTEXTS), (0.0, OTHER_CONTEXTS)):
        for path, template in contexts:
            for k in range(REFERENCE_ROUNDS):
                for c in candidates(_fill(template, k), path, dictionary):
                    out.append((c.features, label, c.text, c.start))
    return out


def train(
    labelled: DataFrame, max_findings: int = MAX_FINDINGS, reference: DataFrame | None = None
) -> Forest:
    """A forest from ``features`` and ``label``; findings without a label are left out.

    Equal findings are one row with a weight. Both kinds have at most half of ``max_findings``
    such rows, chosen by a hash. All of ``reference`` is added beyond that bound, with the share
    ``REFERENCE_SHARE`` of its kind's weight however large the rest. Both kinds weigh the same."""
    grouped = labelled.where("label is not null").groupBy("features", "label")
    grouped = grouped.agg(F.count(F.lit(1)).cast("double").alias("n"))
    rows = None
    for label in (0.0, 1.0):
        order = (F.xxhash64("features"), "features")
        one = grouped.where(F.col("label") == label).orderBy(*order).limit(max_findings // 2)
        rows = one if rows is None else rows.unionByName(one)
    rows = rows.withColumn("is_reference", F.lit(False))
    if reference is not None:
        given = reference.select("features", "label", F.lit(1.0).alias("n"), F.lit(True).alias("is_reference"))
        rows = rows.unionByName(given)
    rows = stored(rows, "secret-findings")
    parts = rows.groupBy("label", "is_reference").agg(F.sum("n").alias("total"), F.count("n").alias("rows")).collect()
    if len({r.label for r in parts}) < 2:
        return Forest([])
    size = sum(r["rows"] for r in parts)
    weight = F.lit(None).cast("double")
    for r in parts:
        alone = sum(x.label == r.label for x in parts) == 1
        share = 1.0 if alone else REFERENCE_SHARE if r.is_reference else 1 - REFERENCE_SHARE
        is_part = (F.col("label") == r.label) & (F.col("is_reference") == r.is_reference)
        weight = F.when(is_part, F.col("n") * (size * share / r.total)).otherwise(weight)
    rows = rows.select(array_to_vector("features").alias("features"), "label", weight.alias("weight"))
    fitted = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", minInstancesPerNode=2
    ).fit(rows)
    return _exported(labelled.sparkSession, fitted)


def _exported(spark: SparkSession, fitted) -> Forest:
    """The trees of a fitted forest, read from the format that ``spark.ml`` saves them in."""
    folder = new_folder(spark, "secret-forest")
    fitted.write().save(folder)
    trees: dict[int, dict[int, tuple]] = {}
    for row in spark.read.parquet(f"{folder}/data").collect():  # bounded by number and depth of trees
        node = row.nodeData
        stats = node.impurityStats
        split = node.split
        threshold = split.leftCategoriesOrThreshold[0] if split.featureIndex >= 0 else 0.0
        share = stats[1] / sum(stats) if sum(stats) else 0.0
        trees.setdefault(row.treeID, {})[node.id] = (
            split.featureIndex, threshold, node.leftChild, node.rightChild, share,
        )
    return Forest([trees[k] for k in sorted(trees)])


def judge(found: DataFrame, forest: Forest) -> DataFrame:
    """``findings`` with their ``score`` and whether they are secrets (a score of a half or more) in place of
    features and label."""
    schema = found.drop("features", "label").schema.add("score", "double").add("is_secret", "boolean")
    kept = [c for c in found.columns if c not in ("features", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([forest.score(v) for v in batch.column("features").to_pylist()], float)
            own = batch.select(kept)
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(scores), pa.array(scores >= 0.5)], schema.names
            )

    return found.mapInArrow(run, schema)


def scan(
    docs: DataFrame,
    forest: Forest,
    dictionary: frozenset[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str = "source",
) -> DataFrame:
    """Every candidate of ``docs`` with its ``score`` and whether it is a secret."""
    return judge(findings(docs, dictionary, id_col, text_col, path_col), forest)


def mask(
    docs: DataFrame,
    forest: Forest,
    dictionary: frozenset[str],
    text_col: str = "text",
    path_col: str = "source",
    with_: str = "[secret]",
) -> DataFrame:
    """``docs``, in whose texts every secret is replaced; what a secret of the greatest length goes on with is part of it."""
    has_path = path_col in docs.columns

    def masked(text: str | None, path: str | None) -> str | None:
        if not text:
            return text
        out, at, is_cut = [], 0, False
        for c in candidates(text, path or "", dictionary):
            goes_on = is_cut and c.start == at
            if c.start >= at and (goes_on or forest.score(c.features) >= 0.5):
                out += [] if goes_on else [text[at : c.start], with_]
                at, is_cut = c.start + len(c.text), len(c.text) == MAX_LENGTH
        return "".join([*out, text[at:]]) if out else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            paths = batch.column(path_col).to_pylist() if has_path else [""] * len(texts)
            changed = [masked(t, p) for t, p in zip(texts, paths, strict=True)]
            place = batch.schema.get_field_index(text_col)
            field = batch.schema.field(place)
            yield batch.set_column(place, field, pa.array(changed, field.type))

    return docs.mapInArrow(tidy(run), docs.schema)


def read_dictionary(path: str) -> frozenset[str]:
    """Words of at least four letters in a rank file's vocabulary, in lower case."""
    from shopmart.llm.bpe import read_ranks

    words = (t.strip() for t in read_ranks(path))
    return frozenset(w.decode().lower() for w in words if len(w) > 3 and w.isascii() and w.isalpha())
