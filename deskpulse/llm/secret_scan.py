"""Secret scans with a random forest that removes false findings.

Candidates in whole texts are long runs of key characters, parts of paths, and whatever is
assigned to a secret word, however short. A forest, trained on labelled findings, decides
from a candidate's length, character transitions, dictionary coverage, path parts and
neighbouring words which of them are secrets.
"""

import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskpulse.llm.common import checkpointed, column

# Runs of key characters. Only these bound a run, so "=", other letters and dots may touch it.
RUN = re.compile(r"(?<![A-Za-z0-9_+/~-])[A-Za-z0-9_+/~-][A-Za-z0-9_+/.~-]{13,}[A-Za-z0-9_+/~-](?:={1,2}(?![A-Za-z0-9_=]))?")
# A part of a run between slashes.
PART = re.compile(r"[^/]{15,}")
# Values of any length assigned to a secret word: in quotes, or up to white space, a quote
# or the next name=.
ASSIGNED = re.compile(
    r"""(?:token|secret|pass(?:w|phrase|(?![a-z]))|pwd|api.?key|access.?key|auth|bearer|credential|private)[A-Za-z0-9_.-]{0,40}
    (?:["'`]?\]?\s{0,4}(?::=|=>|[:=])\s{0,4}(?:(?:bearer|basic)\s{1,4})?|\s{1,4}is\s{1,4}|\s{1,4}(?=["'`])|(?<=bearer)\s{1,4})
    (?:"(?P<double>[^"\n]+)"|'(?P<single>[^'\n]+)'|`(?P<back>[^`\n]+)`|["'`]?(?P<bare>(?:(?![&,;][A-Za-z0-9_.-]+=)[^\s"'`])+))""",
    re.I | re.X,
)
# A password in front of the host of a url.
USERINFO = re.compile(r"://[^\s/:@]*:([^\s/@]+)@")
CLOSING = ".,;:)]}>"
# Words around a finding that speak for, and against, a secret.
SECRET_WORDS = re.compile(r"token|secret|passw|passphrase|pwd|api.?key|access.?key|auth|bearer|credential|private", re.I)
OTHER_WORDS = re.compile(r"sha\d*|md5|digest|hash|commit|checksum|etag|uuid|guid|version|build|href|src|file|example|https?:", re.I)
AFTER_ASSIGNMENT = re.compile(r"[:=]\s*[\"'`]?$")
AROUND = 40
FEATURES = (
    "length", "digits", "capitals", "turns", "entropy", "surprise", "dictionary", "slashes",
    "separators", "hex", "secret_words", "other_words", "assigned", "quoted", "filler",
    "symbols", "userinfo",
)
# Documents that labelled findings are drawn from, about, and findings of each.
SAMPLE_DOCUMENTS = 2000
SAMPLE_CHARACTERS = 20_000
TREES = 30
DEPTH = 8
THRESHOLD = 0.5
WORD = r"\p{L}{4,}"
DICTIONARY = 20_000
PAIRS = 50_000
MASK = "[SECRET]"


def _kind(c):
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o"


class Language:
    """Frequent words, and how surprising a letter is after another, in bits."""

    def __init__(self, words, pairs):
        self.words = set(words)
        firsts = Counter()
        for pair, n in pairs.items():
            firsts[pair[0]] += n
        self.surprise = {
            (p[0], p[1]): float(-np.log2((n + 0.5) / (firsts[p[0]] + 20.0))) for p, n in pairs.items()
        }

    def transitions(self, text):
        """Mean surprise of a character by the one before, in bits."""
        low = text.lower()
        total = sum(self.surprise.get(p, 10.0) for p in zip(low, low[1:]))
        return total / max(1, len(low) - 1)

    def coverage(self, text):
        """Share of the characters that dictionary words of four letters or more cover."""
        low, at, covered = text.lower(), 0, 0
        while at + 4 <= len(low):
            size = next(
                (n for n in range(min(12, len(low) - at), 3, -1) if low[at : at + n] in self.words), 0
            )
            covered += size
            at += size or 1
        return covered / len(low)


def features(text, start, end, language):
    found = text[start:end]
    n = len(found)
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    kinds = [_kind(c) for c in found]
    counts = np.array(list(Counter(found).values())) / n
    separators = sum(found.count(c) for c in "-_.~")
    return (
        float(n),
        kinds.count("d") / n,
        kinds.count("u") / n,
        sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
        float(-(counts * np.log2(counts)).sum()),
        language.transitions(found),
        language.coverage(found),
        found.count("/") / n + float(before.endswith(("/", "\\"))),
        separators / n,
        float(all(c in "0123456789abcdefABCDEF" for c in found)),
        float(bool(SECRET_WORDS.search(before))),
        float(bool(OTHER_WORDS.search(before)) or bool(OTHER_WORDS.search(after[:12]))),
        float(bool(AFTER_ASSIGNMENT.search(before))),
        float(before[-1:] in tuple("\"'`") and after[:1] in tuple("\"'`")),
        float(max(counts)),
        sum(not c.isalnum() and c not in "-_.~/+= " for c in found) / n,
        float(after[:1] == "@" and before[-1:] == ":"),
    )


def candidates(text):
    """Spans of a text that may be secrets, in order; they may overlap."""
    spans = set()
    for m in RUN.finditer(text):
        spans.add(m.span())
        if "/" in m.group():
            spans.update(p.span() for p in PART.finditer(text, *m.span()))
    for m in ASSIGNED.finditer(text):
        start, end = m.span(m.lastgroup)
        if m.lastgroup == "bare":
            end = start + len(text[start:end].rstrip(CLOSING))
        if start < end:
            spans.add((start, end))
    spans.update(m.span(1) for m in USERINFO.finditer(text))
    return sorted(spans)


def nearest_candidate(spans, start, end):
    """The span that shares most with another one, or None."""
    shared = [(min(s[1], end) - max(s[0], start), s[0] - s[1], s) for s in spans]
    shared = [s for s in shared if s[0] > 0]
    return max(shared)[2] if shared else None


def joined(found):
    """(start, end, score) in order, overlapping ones as one with the highest score."""
    result = []
    for start, end, score in sorted(found):
        if result and start < result[-1][1]:
            low, high, most = result[-1]
            result[-1] = (low, max(high, end), max(most, score))
        else:
            result.append((start, end, score))
    return result


def planted(text, rng, language_words):
    """(text, start, end, secret): a labelled finding set into a place of a text."""
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    hexes, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    words = [w for w in rng.choices(language_words, k=6)]
    secret = rng.random() < 0.5
    if secret:
        value = rng.choice(
            (
                lambda: pick(hexes, rng.choice((32, 40, 48, 64))),
                lambda: pick(alnum, rng.randint(20, 64)),
                lambda: pick(alnum + "+/", rng.choice((40, 64, 86))) + rng.choice(("", "=", "==")),
                lambda: "AKIA" + pick(string.ascii_uppercase + "234567", 16),
                lambda: rng.choice(("ghp_", "gho_", "glpat-", "npm_")) + pick(alnum, 36),
                lambda: rng.choice(("sk_live_", "rk_live_", "sk-")) + pick(alnum, 32),
                lambda: "eyJ" + pick(alnum, 24) + ".eyJ" + pick(alnum, 40) + "." + pick(alnum + "-_", 43),
                lambda: pick(alnum + "!@#$%^*", rng.randint(8, 24)) + rng.choice("!@#$%^*"),
                lambda: rng.choice(words).capitalize() + pick(string.digits, rng.randint(1, 4)) + rng.choice("!@#$%^*"),
                lambda: pick(alnum, rng.randint(8, 14)),
            )
        )()
        name = rng.choice(
            ("token", "secret", "password", "api_key", "apikey", "access_key", "auth", "client_secret", "passwd", "AWS_SECRET_ACCESS_KEY")
        )
        frame = rng.choice(
            ('{k} = "{v}"', "{k}: {v}", "{k}={v}", '"{k}": "{v}"', "{k} '{v}'", "Bearer {v}", "{k} is {v}", "https://x.org/a?access_{k}={v}", "https://x.org/a?{k}={v}&page=2", "export {k}={v}")
            + (() if re.search("[/@#?]", value) else ("db://user:{v}@host.org/x",))
        )
    else:
        value = rng.choice(
            (
                lambda: pick(hexes, rng.choice((32, 40, 64))),
                lambda: "-".join(pick(hexes, k) for k in (8, 4, 4, 4, 12)),
                lambda: "/".join(words[:4]) + rng.choice((".py", ".html", "/")) + "x",
                lambda: "_".join(words[:3]),
                lambda: "-".join(words[:4]) + "-" + pick(string.digits, 4),
                lambda: "".join(w.capitalize() for w in words[:3]),
                lambda: rng.choice(("x", "0", "-", "A", "_")) * rng.randint(16, 40),
                lambda: rng.choice(("your", "example", "insert", "replace")) + "_" + rng.choice(("token", "password", "api_key")) + "_here",
                lambda: "".join(words[:3]),
                lambda: pick(string.digits, rng.randint(16, 20)),
                lambda: words[0] + rng.choice(("", ".", ",", "()")),
                lambda: " ".join(words[: rng.randint(2, 6)]),
                lambda: rng.choice(("true", "false", "null", "None", "***", "<token>", "${TOKEN}", "required", "1", "42", "3600")),
            )
        )()
        if re.fullmatch(r"[0-9a-f-]{30,}", value):
            name = rng.choice(("sha256", "commit", "md5", "checksum", "digest", "uuid", "etag", "build"))
            frame = rng.choice(("{k} {v}", "{k}: {v}", '{k}="{v}"', "{k}:{v}", "https://{k}.org/{v}"))
        else:
            name = rng.choice(("token", "password", "file", "see", "the", "version", words[5]))
            frame = rng.choice(("{k} = {v}", "{k}={v}", "{k}: {v}", "{k} is {v}", "{k} {v}", '{k}: "{v}"', "{v}", "{k}/{v}", "https://x.org/{v}", "https://x.org/a?{k}={v}"))
    at = rng.randrange(len(text) + 1)
    prefix = text[:at] + " " + frame.split("{v}")[0].format(k=name)
    whole = prefix + value + frame.split("{v}")[1] + " " + text[at:]
    return whole, len(prefix), len(prefix) + len(value), secret


def labelled_findings(texts, language, seed=0, each=6):
    """(features, label) rows of findings whose label is known.

    Each text of the sample takes some findings of known kinds, one at a time: keys and
    passwords in the frames they are stored in, and digests, paths, identifiers and
    placeholders in theirs. Candidates of the texts themselves count as false ones if
    nothing near them speaks of a secret.
    """
    rows = []
    words = sorted(language.words) or ["word"]
    for number, text in enumerate(texts):
        rng = random.Random(f"{seed}|{number}")
        for start, end in candidates(text)[:each]:
            x = features(text, start, end, language)
            if not x[FEATURES.index("secret_words")] and not x[FEATURES.index("assigned")]:
                rows.append((x, 0.0))
        near = text[: 4 * AROUND]
        for _ in range(each):
            whole, start, end, secret = planted(near, rng, words)
            span = nearest_candidate(candidates(whole), start, end)
            if span or secret:
                rows.append((features(whole, *(span or (start, end)), language), float(secret)))
    return rows


class Forest:
    """The trees of a fitted forest as arrays, to score findings inside a task."""

    def __init__(self, model):
        self.trees = [_tree(t.toDebugString) for t in model.trees]

    def score(self, x):
        """Share of the trees that call each row a secret."""
        if not len(x):
            return np.zeros(0)
        votes = np.zeros(len(x))
        for feature, limit, low, high, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                f = np.maximum(feature[at], 0)
                step = np.where(x[np.arange(len(x)), f] <= limit[at], low[at], high[at])
                at = np.where(inner, step, at)
            votes += value[at]
        return votes / len(self.trees)


LINE = re.compile(r"^ *(?:(If|Else) \(feature (\d+) (<=|>) (\S+)\)|Predict: (\S+))$")


def _tree(described):
    """(feature, limit, low, high, value) arrays from the printed form of a tree."""
    lines = [m for m in map(LINE.match, described.splitlines()) if m]
    nodes = []

    def read(i):
        at = len(nodes)
        nodes.append(None)
        kind, feature, _, limit, value = lines[i].groups()
        if value is not None:
            nodes[at] = (-1, 0.0, at, at, float(value))
            return at, i + 1
        low, i = read(i + 1)
        high, i = read(i + 1)  # past its Else line
        nodes[at] = (int(feature), float(limit), low, high, 0.0)
        return at, i

    read(0)
    columns = list(zip(*nodes))
    return tuple(np.array(c) for c in columns)


class Scanner:
    """A dictionary and a forest; finds and scores secrets in texts."""

    def __init__(self, language, forest):
        self.language, self.forest = language, forest

    def scan(self, texts, threshold=THRESHOLD):
        """Per text: number of candidates, and (start, end, score) of the secrets."""
        spans = [candidates(t) for t in texts]
        x = [features(t, *s, self.language) for t, own in zip(texts, spans) for s in own]
        scores = self.forest.score(np.array(x).reshape(-1, len(FEATURES)))
        result, at = [], 0
        for own in spans:
            part = scores[at : at + len(own)]
            at += len(own)
            result.append(
                (len(own), joined((*s, float(p)) for s, p in zip(own, part) if p >= threshold))
            )
        return result


def _most_frequent(counts, most):
    """The rows with the largest ``n``, ``most`` of them at most.

    A histogram on a logarithmic grid (at most 1,024 steps) tells from which step on rows
    are few enough; no task sends rows below it.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = {r["step"]: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    least, held = 1 << 20, 0
    for at in sorted(sizes, reverse=True):
        held += sizes[at]
        if held > most:
            break
        least = at
    return counts.where(step >= least).collect()


def corpus_language(documents, text_col="text"):
    """The Language of all documents, counted in Spark.

    Only frequent words and pairs of letters, ``DICTIONARY`` and ``PAIRS`` of them at
    most, come to the driver; rarer pairs are as surprising as unseen ones.
    """
    words = F.regexp_extract_all(F.lower(column(text_col)), F.lit(WORD), F.lit(0))
    words = documents.select(F.explode(words).alias("word"))
    counts = checkpointed(words.groupBy("word").agg(F.count("*").alias("n")))
    frequent = _most_frequent(counts.where("n > 1"), DICTIONARY)
    starts = F.sequence(F.lit(1), F.char_length("word") - 1)
    pairs = F.transform(starts, lambda i: F.substr(F.col("word"), i, F.lit(2)))
    pairs = counts.select("n", F.explode(pairs).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = _most_frequent(pairs, PAIRS)
    return Language((r["word"] for r in frequent), {r["pair"]: r["n"] for r in pairs})


def sample_texts(documents, text_col="text", sample=SAMPLE_DOCUMENTS):
    """Different texts of about ``sample`` documents, chosen by a hash of the texts.

    Labelled findings are planted into them; of a very long one a part is enough for that.
    """
    texts = documents.select(column(text_col).alias("text")).where("text <> ''")
    every = max(1, documents.count() // sample)
    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    part = F.substring("text", 1, SAMPLE_CHARACTERS)
    return sorted(r[0] for r in chosen.select(part).distinct().toLocalIterator())


def fit(documents, text_col="text", findings=None, sample=SAMPLE_DOCUMENTS, seed=0):
    """A Scanner trained on labelled findings.

    ``findings``: rows of (features, label) of the user's own, added to those planted into
    about ``sample`` documents. Dictionary and letter transitions are those of all
    documents, and the scan itself reads all texts whole.
    """
    spark = documents.sparkSession
    language, texts = corpus_language(documents, text_col), sample_texts(documents, text_col, sample)
    rows = labelled_findings(texts or [""] * 200, language, seed) + list(findings or ())
    frame = spark.createDataFrame(
        [([float(v) for v in x], y) for x, y in rows], "x array<double>, label double"
    ).select(array_to_vector("x").alias("features"), "label")
    model = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt"
    ).fit(frame.repartition(4))
    return Scanner(language, Forest(model))


FOUND = "n_candidates long, n_secrets long, secrets array<struct<start:int,end:int,score:double>>"


def scan(documents, id_col="doc_id", text_col="text", scanner=None, threshold=THRESHOLD):
    """One row per document: ``n_candidates``, ``n_secrets``, ``secrets``.

    ``secrets`` holds start, end (code points) and score of what the forest calls secret;
    overlapping ones are one.
    Null and empty texts have none. Repeated rows are scanned alike, each on its own; an
    empty table gives no rows.
    """
    scanner = scanner or fit(documents, text_col)
    source = documents.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = T.StructType(
        [T.StructField("id", source.schema["id"].dataType), *T._parse_datatype_string(FOUND)]
    )

    def run(batches):
        for batch in batches:
            found = scanner.scan([t or "" for t in batch.column("text").to_pylist()], threshold)
            spans = [[dict(zip(("start", "end", "score"), s)) for s in own] for _, own in found]
            kind = pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([n for n, _ in found], type=pa.int64()),
                    pa.array([len(own) for _, own in found], type=pa.int64()),
                    pa.array(spans, type=kind),
                ],
                names=schema.fieldNames(),
            )

    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def masked(text, spans, mask=MASK):
    parts, at = [], 0
    for start, end, _ in spans:
        parts += [text[at:start], mask]
        at = end
    return "".join([*parts, text[at:]])


def without_secrets(documents, text_col="text", length_col="n_chars", scanner=None, threshold=THRESHOLD):
    """The documents with every secret replaced by a mask; all rows and columns stay.

    ``length_col``, where there is one, is set anew for the texts that changed.
    """
    scanner = scanner or fit(documents, text_col)
    at = documents.columns.index(text_col)
    size_at = documents.columns.index(length_col) if length_col in documents.columns else None

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            found = scanner.scan([t or "" for t in texts], threshold)
            new = [masked(t, own) if own else t for t, (_, own) in zip(texts, found)]
            columns = list(batch.columns)
            columns[at] = pa.array(new, type=batch.schema.field(at).type)
            if size_at is not None:
                sizes = [
                    len(t) if own else n
                    for n, t, (_, own) in zip(batch.column(size_at).to_pylist(), new, found)
                ]
                columns[size_at] = pa.array(sizes, type=batch.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(run, documents.schema)
