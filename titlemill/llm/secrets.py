"""Secret scans with a battery of randomness tests (operator 6)."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titlemill.llm.common import blocks, stored, whole_text

# The patterns of the base scan, with the least length of what counts.
KINDS = ("assign", "access", "hex")
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = re.compile(rf"(?i:{KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6

#: Strings that may be keys: runs of the usual encodings' characters, at least so long.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
#: Encodings, narrowest first: name, alphabet by classes of characters that a random key of it
#: has in proportion to the class sizes.
ENCODINGS = (
    ("hex", ("0123456789", "abcdef")),
    ("HEX", ("0123456789", "ABCDEF")),
    ("base32", ("234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    ("base36", ("0123456789", "abcdefghijklmnopqrstuvwxyz")),
    ("base62", ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    ("base64", ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "+/-_")),
)
LENGTH_STEP = 8
#: p values are binned by their logarithm, so that the discovery level comes from a table of fixed size.
BINS_PER_UNIT = 16
MOST_BINS = 40 * BINS_PER_UNIT


def _gamma_tail(shape: float, x: float) -> float:
    """Upper regularised incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + shape * math.log(x) - math.lgamma(shape))
    if x < shape + 1:
        term = total = 1 / shape
        n = shape
        while term > total * 1e-12:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - front * total)
    b = x + 1 - shape
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 300):
        a = -i * (i - shape)
        b += 2
        d = 1 / (a * d + b or 1e-300)
        c = b + a / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-12:
            break
    return min(1.0, front * h)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def encoding_of(text: str) -> tuple[str, tuple[str, ...]] | None:
    """The narrowest encoding that has all characters of `text`, padding aside."""
    own = set(text.rstrip("="))
    return next(((n, classes) for n, classes in ENCODINGS if own <= set("".join(classes))), None)


def battery(text: str) -> tuple[str, float] | None:
    """Encoding of `text` and the p value of "uniformly random in it"; None without an encoding.

    Three tests, the smallest p value times three: chi-squared of character classes against their
    share of the alphabet, of single characters against uniform where 5 of each are expected; the
    number of runs above and below the alphabet's middle; serial correlation of code values.
    """
    found = encoding_of(text)
    if found is None:
        return None
    name, classes = found
    body = text.rstrip("=")
    alphabet = "".join(classes)
    n, size = len(body), len(alphabet)
    chi = 0.0
    for chars in classes:
        expected = n * len(chars) / size
        chi += (sum(map(body.count, chars)) - expected) ** 2 / expected
    tests = [_gamma_tail((len(classes) - 1) / 2, chi / 2)]
    if n >= 5 * size:
        expected = n / size
        full = sum((body.count(c) - expected) ** 2 / expected for c in alphabet)
        tests.append(_gamma_tail((size - 1) / 2, full / 2))
    else:
        # too short for single counts: pairs of equal characters against their expected number
        pairs = sum(k * (k - 1) / 2 for k in map(body.count, set(body)))
        mean = n * (n - 1) / 2 / size
        tests.append(_two_sided(max(0.0, (pairs - mean) / math.sqrt(mean * (1 - 1 / size)))))
    values = [alphabet.index(c) for c in body]
    high = [v >= size / 2 for v in values]
    up = sum(high)
    down = n - up
    if up and down:
        runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
        mean = 2 * up * down / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        tests.append(_two_sided((runs - mean) / spread))
    else:
        tests.append(2 * 0.5**n)
    middle = sum(values) / n
    total = sum((v - middle) ** 2 for v in values)
    if total:
        lag = sum((a - middle) * (b - middle) for a, b in zip(values, values[1:], strict=False))
        tests.append(_two_sided((lag / total + 1 / n) * math.sqrt(n)))
    else:
        tests.append(float(size) ** (1 - n))
    return name, min(1.0, len(tests) * min(tests))


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, start of the value) of the base scan, code points, by start, then kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in ("passw", "secret", "token", "api")):
        spans = [(0, *m.span(), m.start(1)) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(1, *m.span(), m.start()) for m in ACCESS.finditer(text)]
    spans += [(2, *m.span(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


def _bin(p: float) -> int:
    return min(int(-math.log10(max(p, 1e-300)) * BINS_PER_UNIT), MOST_BINS)


SCHEMA = (
    "base array<struct<kind:int,start:int,end:int>>, "
    "found array<struct<encoding:string,start:int,end:int,band:int,bin:int>>"
)


def scan(docs: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text hash, base spans and tested strings of every row; texts are read once.

    `carried` columns of `docs` come along in a struct _row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema(
            [
                ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))),
                (
                    "found",
                    pa.list_(
                        pa.struct([
                            ("encoding", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("band", pa.int32()), ("bin", pa.int32()),
                        ])
                    ),
                ),
            ]
        )
        for batch in blocks(batches, "_text"):
            base, found = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                base.append([{"kind": k, "start": s, "end": e} for k, s, e, _ in base_spans(text)])
                tested = []
                for match in CANDIDATE.finditer(text):
                    verdict = battery(match[0])
                    if verdict:
                        start, end = match.span()
                        tested.append({
                            "encoding": verdict[0], "start": start, "end": end,
                            "band": (end - start) // LENGTH_STEP, "bin": _bin(verdict[1]),
                        })
                found.append(tested)
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(base, kinds[0].type), pa.array(found, kinds[1].type)],
                names=[*batch.schema.names[:-1], "base", "found"],
            )

    row = [F.struct(*carried).alias("_row")] if carried else []
    own = docs.select("doc_id", F.xxhash64(whole_text()).alias("_hash"), *row, whole_text().alias("_text"))
    return own.mapInArrow(run, StructType([*own.schema.fields[:-1], *StructType.fromDDL(SCHEMA).fields]))


def discovery_bins(scanned: DataFrame, level: float) -> dict[tuple[str, int], int]:
    """Per encoding and length band, the least bin whose strings are called not random.

    The step-up rule of Benjamini and Hochberg on p values binned by logarithm, each taken at its
    bin's upper end. Longer strings have their own bands, as a test's power grows with length. The
    table read here has at most encodings x bands x bins rows, whatever the corpus; bands above 64
    are one.
    """
    rows = (
        scanned.select(F.explode("found").alias("f"))
        .groupBy("f.encoding", F.least(F.col("f.band"), F.lit(64)).alias("band"), "f.bin")
        .count()
        .collect()
    )
    by_group: dict[tuple[str, int], dict[int, int]] = {}
    for r in rows:
        by_group.setdefault((r["encoding"], r["band"]), {})[r["bin"]] = r["count"]
    cut = {}
    for group, bins in by_group.items():
        total, seen, best = sum(bins.values()), 0, MOST_BINS + 1
        for b in sorted(bins, reverse=True):
            seen += bins[b]
            if 10 ** (-b / BINS_PER_UNIT) <= level * seen / total:
                best = b
        cut[group] = best
    return cut


def secrets(docs: DataFrame, level: float = 0.05, carried: tuple[str, ...] = ()) -> DataFrame:
    """`docs` (doc_id, text, more) -> doc_id, _hash, base and added spans of every row; `carried`
    columns come along in a struct _row.

    base: array of (kind, start, end) of the patterns, kinds numbered as in KINDS; found: strings
    whose randomness no test of the battery rejects, by start, where no base span covers them. The
    share of truly random strings among those rejected is held to `level` per encoding and length
    band over the whole corpus. Offsets are code points, ends exclusive.

    A null or empty text has no spans; a null doc_id stays null; each repeated row gives a row and
    counts in the corpus statistics; other columns are ignored; no row gives no row.
    """
    scanned = stored(scan(docs, carried), "scanned")
    cut = discovery_bins(scanned, level)
    tables = {}
    for (encoding, band), b in cut.items():
        tables[f"{encoding}:{band}"] = b
    pairs = [F.lit(x) for item in tables.items() for x in item]
    least = F.create_map(*pairs) if pairs else F.create_map(F.lit(""), F.lit(0))
    random = F.filter(
        "found",
        lambda f: f["bin"] < F.coalesce(
            F.element_at(least, F.concat_ws(":", f["encoding"], F.least(f["band"], F.lit(64)))), F.lit(0)
        ),
    )
    new = F.filter(
        random, lambda f: ~F.exists("base", lambda b: (b["start"] <= f["start"]) & (f["end"] <= b["end"]))
    )
    return scanned.withColumn("found", new)


def joined_spans(base, found=None):
    """kind:start:end by start, then kind, comma-joined."""
    order = F.transform(base, lambda b: F.struct(b["start"], b["kind"], F.element_at(F.array(*map(F.lit, KINDS)), b["kind"] + 1).alias("name"), b["end"]))
    if found is not None:
        added = F.transform(found, lambda f: F.struct(f["start"], F.lit(len(KINDS)).alias("kind"), F.concat(F.lit("random_"), f["encoding"]).alias("name"), f["end"]))
        order = F.concat(order, added)
    return F.array_join(F.transform(F.sort_array(order), lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, level: float = 0.05, mask: str = "[SECRET]") -> DataFrame:
    """`docs` with every span of `secrets` replaced by `mask`, overlapping ones by one.

    Rows and columns stay as they are; n_chars, if there is one, follows the new text. Rows come
    along with their spans through the scan, so no text is shuffled; one without spans stays.
    """
    joined = secrets(docs, level, tuple(docs.columns)).select("_row.*", F.sort_array(F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))),
        F.transform("found", lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"))),
    )).alias("_spans"))
    tail = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    cut = F.aggregate(
        "_spans", tail,
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
            F.concat(acc["done"], F.substring("text", acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)).alias("done"),
            s["end"].alias("at"),
        )).otherwise(F.struct(acc["done"].alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))),
    )
    whole = F.concat(cut["done"], F.substring("text", cut["at"] + 1, F.length("text")))
    changed = joined.withColumn("text", F.when(F.size("_spans") == 0, F.col("text")).otherwise(whole))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.when(F.size("_spans") == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return changed.select(*docs.columns)
