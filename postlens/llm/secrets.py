"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are, whatever their length and characters, the values of assignments to
names with a key word (``my_token=...``, ``"apiKey": "..."``, ``Authorization: Bearer
...``), and runs of 16 or more characters of keys and encodings with a digit
or after a key word. A run that begins with a name and = is two: the name, and the value. The forest (Spark MLlib) judges each by its length, character
transitions, dictionary coverage (by the words of a vocabulary file, where one is
named), the document's path and the neighbouring words. It is trained from labelled findings: a table of ``candidate, before,
after, path, secret``, of which ``MAX_FINDINGS`` at most are used (the first by
hash); ``example_findings`` makes a seeded set, by rule, where a project has none of
its own. What such a set can't show is how often real texts hold each form.

Edge cases: a value in quotes ends with its line, another at a blank or quote (in
a URL's query at & or #), without closing punctuation; a run inside a longer value
is a candidate of its own; null and empty texts have no candidates; a candidate that stands
several times in a text is reported at each place; a null path is an empty one;
rows that repeat are scanned one by one; an empty table gives an empty result.
Only ``doc_id``, ``text`` and the path column are read.
"""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store

MAX_FINDINGS = 20_000
_RUN = "A-Za-z0-9+/_=-"
CANDIDATE = re.compile(rf"(?<![{_RUN}])[{_RUN}]{{16,}}")
_NAME_BEFORE = re.compile(r"([\w.-]+)[ \t]+[\"'`]?$")
#: A name and = at the start of a run; = at its end is padding.
LEADING = re.compile(r"[A-Za-z_][A-Za-z0-9_+/-]*+=(?=[^=])")
_ASSIGN = r"[\"'`\]]{0,2}[ \t]*+(?:=>|:=|={1,3}|:)[ \t]*+(?:(?i:bearer|basic|token)[ \t]++)?"
ASSIGNED = re.compile(rf"(?<![\w.-])([\w.-]++){_ASSIGN}(?:\"((?:[^\"\\\n]|\\.)++)\"|'((?:[^'\\\n]|\\.)++)'|`([^`\n]++)`|[\"'`]?([^\s\"'`]++))")
_ASSIGNED_BEFORE = re.compile(rf"(?<![\w.-])([\w.-]++){_ASSIGN}[\"'`]?$")
AROUND = 48
#: Fixed word lists of the features.
KEY_WORDS = ("access", "api", "apikey", "auth", "bearer", "client", "credential", "key", "passwd", "password", "private", "pwd", "secret", "token")
#: Endings of names that are written as one word (dbpassword), and further names.
KEY_ENDINGS = ("apikey", "authorization", "credentials", "passphrase", "passwd", "password", "pwd", "secret", "token")
PLACEHOLDERS = re.compile(r"(?i)^(?:[<{(\[$%].*|(?:null|none|nil|true|false|undefined|todo|required|optional|string|redacted|change.?me)\W*|your.*|x{3,}|\*+|\.+|.*[\w\])][(\[].*|(?:os|process|env|self|this|config|settings)\..*)$")
HARMLESS_WORDS = ("checksum", "commit", "digest", "etag", "fixture", "id", "isbn", "md5", "number", "order", "page", "revision", "sha", "sha1", "sha256", "uuid", "version")
DICTIONARY = ("access", "application", "build", "case", "class", "client", "commit", "config", "content", "data", "default", "example", "file", "function", "handler", "image", "index", "item", "learning", "library", "license", "list", "local", "main", "manager", "message", "model", "module", "number", "object", "order", "package", "page", "project", "release", "report", "request", "resource", "response", "result", "server", "service", "session", "source", "static", "string", "table", "template", "test", "thread", "update", "user", "value", "version", "window", "world")
TEST_PATHS = ("doc", "example", "fixture", "mock", "sample", "spec", "test")
CONFIG_PATHS = (".cfg", ".env", ".ini", ".pem", ".properties", ".toml", ".yaml", ".yml", "conf", "credential", "deploy", "secret")
FEATURES = ("length", "digits", "upper", "lower", "changes", "entropy", "distinct", "letter_pairs", "dictionary", "hex", "numeric", "uuid", "slashes", "key_word", "assigned", "harmless_word", "test_path", "config_path", "punctuation", "keyed", "placeholder")
_PAIRS = frozenset(w[i : i + 2] for w in DICTIONARY for i in range(len(w) - 1))
#: Lengths of dictionary words that count.
WORD_LENGTHS = range(4, 15)
_dictionaries: dict[str | None, frozenset[str]] = {}


def dictionary(vocabulary: str | None) -> frozenset[str]:
    """Lower-case words: those that a byte-level tokenizer file has as one token behind a space, or the few of DICTIONARY."""
    if vocabulary not in _dictionaries:
        words = set(DICTIONARY)
        if vocabulary:
            with open(vocabulary, encoding="utf-8") as f:
                words |= {t[1:].lower() for t in json.load(f)["model"]["vocab"] if t[:1] == "\u0120" and re.fullmatch("[A-Za-z][a-z]+", t[1:])}
        _dictionaries[vocabulary] = frozenset(w for w in words if len(w) in WORD_LENGTHS)
    return _dictionaries[vocabulary]
_UUID = re.compile(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
_WORD = re.compile(r"[a-z0-9]+")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def names_key(name: str) -> bool:
    """Whether a part of the name (snake, kebab or camel case) is a key word."""
    return name.lower().endswith(KEY_ENDINGS) or any(x.lower() in KEY_WORDS for x in _PART.findall(name))


def spans(text: str) -> list[tuple[int, int]]:
    """Start and end of each candidate, in order."""
    found = set()
    digit = lambda part: any(k in "0123456789" for k in part)
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if not digit(m.group()):
            name = _NAME_BEFORE.search(text[max(0, a - AROUND) : a])
            if not (name and names_key(name.group(1))):
                continue
        name = LEADING.match(text, a, b)
        if name:
            for x, y in ((a, name.end() - 1), (name.end(), b)):
                if y - x >= 16 and digit(text[x:y]):
                    found.add((x, y))
        else:
            found.add((a, b))
    at = 0
    while m := ASSIGNED.search(text, at):
        at = m.end(1)
        if not names_key(m.group(1)):
            continue
        k = next(k for k in (2, 3, 4, 5) if m.group(k) is not None)
        a, b = m.span(k)
        if k == 5:
            if m.start() and text[m.start() - 1] in "?&":
                b = a + re.search(r"[&#]|$", m.group(k)).start()
            b = a + len(text[a:b].rstrip(".,;:)]}>"))
        if a < b:
            found.add((a, b))
    return sorted(found)


def coverage(low: str, words: frozenset[str]) -> float:
    """The share of characters that dictionary words cover."""
    covered, end = 0, 0
    for i in range(len(low) - WORD_LENGTHS.start + 1):
        longest = next((k for k in reversed(WORD_LENGTHS) if i + k <= len(low) and low[i : i + k] in words), 0) if low[i].isalpha() else 0
        covered += max(0, i + longest - max(i, end))
        end = max(end, i + longest)
    return covered / len(low)


def features(candidate: str, before: str, after: str, path: str, words: frozenset[str] = frozenset(DICTIONARY)) -> list[float]:
    """The numbers that the forest sees, in the order of FEATURES. before, after: the text around, AROUND characters each."""
    n, low = len(candidate), candidate.lower()
    kinds = [_kind(c) for c in candidate]
    counts = [candidate.count(c) for c in set(candidate)]
    letters = [low[i : i + 2] for i in range(n - 1) if low[i : i + 2].isalpha()]
    near = _WORD.findall(before.lower())[-4:] + _WORD.findall(after.lower())[:1]
    name = _ASSIGNED_BEFORE.search(before)
    path = path.lower()
    return [
        math.log2(n),
        kinds.count(0) / n,
        kinds.count(1) / n,
        kinds.count(2) / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        -sum(k / n * math.log2(k / n) for k in counts),
        len(counts) / min(n, 64),
        sum(p in _PAIRS for p in letters) / len(letters) if letters else 0.0,
        coverage(low, words),
        float(all(c in "0123456789abcdef" for c in low)),
        float(candidate.isdigit()),
        float(bool(_UUID.match(candidate))),
        candidate.count("/") / n,
        float(any(w in KEY_WORDS for w in near)),
        float(bool(re.search(r"[=:]\s*[\"'`]?$", before))),
        float(any(w in HARMLESS_WORDS for w in near)),
        float(any(w in path for w in TEST_PATHS)),
        float(any(w in path for w in CONFIG_PATHS)),
        kinds.count(3) / n,
        float(bool(name) and names_key(name.group(1))),
        float(bool(PLACEHOLDERS.match(candidate))),
    ]


_DIGIT, _SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_BIG = _SMALL.upper()


def _some(r: random.Random, alphabet: str, n: int) -> str:
    return "".join(r.choices(alphabet, k=n))


#: Kinds of keys, each with what makes one.
KEY_KINDS = {
    "hex": lambda r: _some(r, _DIGIT + "abcdef", r.choice([32, 40, 64])),
    "upper_hex": lambda r: _some(r, _DIGIT + "ABCDEF", r.choice([32, 40])),
    "base62": lambda r: _some(r, _DIGIT + _SMALL + _BIG, r.randint(20, 48)),
    "cloud_id": lambda r: "AKIA" + _some(r, _DIGIT + _BIG, 16),
    "base64": lambda r: _some(r, _DIGIT + _SMALL + _BIG + "+/", 40),
    "padded": lambda r: _some(r, _DIGIT + _SMALL + _BIG + "_-", 43) + "=",
    "prefixed": lambda r: r.choice(["ghp_", "sk_live_", "xoxb-", "glpat-"]) + _some(r, _DIGIT + _SMALL + _BIG, 36),
    "short": lambda r: _some(r, r.choice([_SMALL + _DIGIT, _SMALL + _BIG + _DIGIT]), r.randint(8, 15)),
    "letters": lambda r: _some(r, r.choice([_SMALL, _SMALL + _BIG]), r.randint(10, 35)),
    "punctuated": lambda r: _some(r, _SMALL + _BIG + _DIGIT + "!@#$%^&*?", r.randint(8, 24)),
    "word_based": lambda r: r.choice([r.choice(DICTIONARY).title() + _some(r, _DIGIT, 4) + _some(r, "!@#$%", 1), _some(r, _SMALL, 4) + _some(r, _DIGIT, 2) + _some(r, _SMALL + "!@#%", 6)]),
}
#: Those that stand without a name too: no checksum or identifier has their form.
BARE_KINDS = ("base62", "cloud_id", "base64", "prefixed")


def example_findings(spark: SparkSession, count: int = 6000, seed: int = 5, without: tuple[str, ...] = ()) -> DataFrame:
    """Labelled findings made by rule: keys as services hand them out, and look-alikes. ``kind`` says which, kinds ``without`` are left out."""
    r = random.Random(seed)
    filler = ["the", "of", "and", "to", "in", "that", "with", "for", "was", "see", "new", "from", "then", "we", "it", "as", "by"]
    prose = lambda n: " ".join(r.choice(filler) for _ in range(n))
    hexed = lambda n: _some(r, _DIGIT + "abcdef", n)
    word = lambda: r.choice(DICTIONARY)
    kinds, bare = [k for k in KEY_KINDS if k not in without], [k for k in BARE_KINDS if k not in without]
    named = [*KEY_WORDS, "db_password", "apiKey", "accessToken", "DB_PASS_SECRET", "client-secret"]
    rows = []
    for i in range(count):
        path = r.choice(["", "", "crawl", "web/pages", "app/config.yml", "deploy/.env", "tests/test_api.py", "docs/readme.md"])
        if i % 2:
            alone = r.random() < 0.15
            kind = r.choice(bare if alone else kinds)
            key = KEY_KINDS[kind](r)
            name = "" if alone else r.choice(named)
            lead = r.choice([f'{name} = "', f"{name}: ", f'"{name}": "', f"{name}='", f"{name}=", f"my_{name}=", f'{name.upper()} = "'] + [f"{name} "] * (kind not in ("short", "letters", "punctuated", "word_based"))) if name else r.choice(["", "(", '"', "\n"])
            before = prose(3) + " " + lead
            after = (lead[-1] + r.choice([" ", "\n", ", ", "; "]) if lead[-1:] in ("'", '"') else r.choice(["\n", " "])) + prose(2)
        else:
            kind, key = "look-alike", r.choice(
                [
                    _some(r, _DIGIT, r.randint(16, 20)),
                    "-".join([hexed(8), hexed(4), hexed(4), hexed(4), hexed(12)]),
                    "/".join(word() for _ in range(r.randint(3, 5))) + _some(r, _DIGIT, 2),
                    "_".join(word() for _ in range(3)) + _some(r, _DIGIT, r.randint(1, 4)),
                    word().title() + word().title() + word().title() + _some(r, _DIGIT, 2),
                    "20" + _some(r, _DIGIT, 2) + "-" + _some(r, _DIGIT, 2) + "-" + _some(r, _DIGIT, 2) + "-" + word() + "-" + word(),
                    hexed(40),
                    hexed(64),
                    hexed(32),
                    "=" * r.randint(16, 60) + _some(r, _DIGIT, 1),
                    _some(r, _SMALL, 2) * r.randint(8, 20) + _some(r, _DIGIT, 1),
                ]
            )
            random_hex = len(key) in (32, 40, 64) and all(c in "0123456789abcdef" for c in key)
            lead = r.choice(HARMLESS_WORDS) if random_hex else r.choice(["", "", r.choice(HARMLESS_WORDS), r.choice(filler)])
            before = prose(3) + " " + r.choice([lead + " ", lead + ": ", lead + "="] if lead else [" ", "(", "\n"])
            after = r.choice([" ", ". ", "\n", ") "]) + prose(2)
            if r.random() < 0.45:  # beside a key word too
                stubs = [r.choice(["your-", "your_", "my-", "insert-", "the_"]) + r.choice([word(), *KEY_WORDS]) + r.choice(["", "", "-here"]) for _ in range(2)]
                kind, key = "placeholder", r.choice([word(), word() + "_" + word(), word() + "-" + word(), word() + "." + word() + "." + word(), r.choice(filler), "null", "None", "true", *[f"<{x}>" for x in stubs], "${" + stubs[0].upper() + "}", *stubs, "xxxxxxxx", "********", "os.environ.get(" + word().upper() + ")", "get_" + word() + "()", "/".join(word() for _ in range(3)), _some(r, _DIGIT, r.randint(1, 4)), word() + _some(r, _DIGIT, 1), "https://" + word() + ".example.com/" + word()])
                name = r.choice([*KEY_WORDS, "primary_key", "api_key", "accessToken", "db_password"])
                lead = r.choice([f'{name} = "', f"{name}: ", f'"{name}": "', f"{name}='", f"my_{name}=", f'{name.upper()} = "'])
                key = key if lead[-1] in "'\"" else key.rstrip(">})")
                before, after = prose(3) + " " + lead, (lead[-1] if lead[-1] in "'\"" else "") + r.choice([" ", "\n"]) + prose(2)
        rows.append((key, before[-AROUND:], after[:AROUND], path, i % 2, kind))
    return spark.createDataFrame(rows, "candidate string, before string, after string, path string, secret int, kind string")


def _rows_to_features(vocabulary: str | None):
    def rows_to_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary(vocabulary)
        for batch in batches:
            columns = [batch.column(k).fill_null("").to_pylist() for k in ("candidate", "before", "after", "path")]
            rows = [features(*x, words) for x in zip(*columns)]
            yield pa.record_batch([batch.column("secret").cast(pa.float64()), *[pa.array([x[i] for x in rows], pa.float64()) for i in range(len(FEATURES))]], names=["label", *FEATURES])

    return rows_to_features


def train(findings: DataFrame, trees: int = 20, depth: int = 8, vocabulary: str | None = None) -> PipelineModel:
    """A forest from labelled findings (``secret``: 1 or 0; candidates of a character or more).

    Fit once and keep it (``model.write()``) where more than one table is scanned; a scan names the same ``vocabulary``.
    """
    known = findings.where(F.col("secret").isNotNull() & (F.length("candidate") > 0))
    known = known.orderBy(F.xxhash64("candidate", "before", "after", "path"), "candidate", "before").limit(MAX_FINDINGS).coalesce(1)
    rows = known.select("candidate", "before", "after", "path", "secret").mapInArrow(_rows_to_features(vocabulary), ", ".join(f"{x} double" for x in ("label", *FEATURES)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featuresCol="features", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="features"), forest]).fit(rows)


def candidates(docs: DataFrame, path: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, start, length, sha256`` and the features of each candidate; places count characters from 0."""
    store.small_batches(docs.sparkSession)
    names = ["doc_id", "start", "length_chars", "sha256", *FEATURES]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * len(FEATURES)]
            return pa.record_batch([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names=names)

        words = dictionary(vocabulary)
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py() or ""
                for a, b in spans(text):
                    where = batch.column("path")[i].as_py() or ""
                    rows.append([batch.column("doc_id")[i].as_py(), a, b - a, hashlib.sha256(text[a:b].encode()).hexdigest(), *features(text[a:b], text[max(0, a - AROUND) : a], text[b : b + AROUND], where, words)])
                    if len(rows) == 4000:
                        yield made(rows)
                        rows = []
            if rows:
                yield made(rows)

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.col(path).cast("string") if path else F.lit("")).alias("path"))
    return asked.mapInArrow(scan, "doc_id long, start long, length_chars long, sha256 string, " + ", ".join(f"{x} double" for x in FEATURES))


def scan(docs: DataFrame, model: PipelineModel, path: str | None = None, at_least: float = 0.5, vocabulary: str | None = None) -> DataFrame:
    """All candidates with the forest's probability: ``doc_id, start, length, sha256, probability, is_secret``."""
    judged = model.transform(candidates(docs, path, vocabulary)).withColumn("p", vector_to_array("probability")[1])
    return judged.select("doc_id", "start", F.col("length_chars").alias("length"), "sha256", F.col("p").alias("probability"), (F.col("p") >= at_least).alias("is_secret"))
