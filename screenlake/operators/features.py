"""Entity featurization from text (FP1-FP4, J3-J5, X2, X3, X7).

The reference parses line-notation strings with a per-row chemistry library.
Here featurization is re-aimed at expressions Spark evaluates in the JVM:

* FP1 hashed substring fingerprint (LINGO-style): digits -> '0', every
  q-character substring of the *whole* text, md5 folded to ``nbits``.
  Long form ``(key, bit, cnt)``; never 512 dense columns.
* FP2 pattern keys: a user table of (key_id, regex, min_count), evaluated as
  one projection (no join of patterns against rows).
* FP3 distinct-entity featurize: ``distinct -> mapInPandas(kernel) -> join
  back``; a kernel runs once per distinct string, whatever its row count.
* FP4 string descriptors: token-class counts, named ``s_*``.

Featurize distinct texts first and join group columns afterwards (J4): the
same string shared by many rows is processed once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenlake.functions.hashing import hash_bucket
from screenlake.operators.skew import salted_join

# Fingerprint widths by kind.
FP_WIDTHS = {"morgan": 512, "maccs": 167, "both": 512 + 167}
DEFAULT_NBITS = 512
GRAM = 4

# Line-notation tokenizer (bracket atoms, two-letter halogens,
# organic subset, aromatic atoms, bonds, branches, ring closures).
TOKEN_RE = r"(\[[^\]]+]|Br?|Cl?|N|O|S|P|F|I|b|c|n|o|s|p|\(|\)|\.|=|#|-|\+|\\|/|:|~|@|\?|>|\*|\$|%[0-9]{2}|[0-9])"

# Standard atomic weights used for the heavy-atom mass.
ATOMIC_WEIGHTS = {"B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998,
                  "P": 30.974, "S": 32.06, "Cl": 35.45, "Br": 79.904, "I": 126.904}

# Default structural pattern keys (key_id, regex, min_count).
DEFAULT_PATTERNS = [
    (1, r"Cl", 1), (2, r"Br", 1), (3, r"F", 1), (4, r"I", 1), (5, r"N", 1), (6, r"N", 2),
    (7, r"O", 1), (8, r"O", 2), (9, r"S", 1), (10, r"P", 1), (11, r"=O", 1), (12, r"#", 1),
    (13, r"=", 2), (14, r"\(", 1), (15, r"\(", 3), (16, r"[0-9]", 2), (17, r"c", 6),
    (18, r"n", 1), (19, r"@", 1), (20, r"\[[^\]]*[+-][^\]]*\]", 1), (21, r"\[Dy\]", 1),
    (22, r"C\(=O\)", 1), (23, r"OC", 1), (24, r"NC", 1), (25, r"CC", 3),
]

DESCRIPTOR_NAMES = ["s_tokens", "s_heavy_atoms", "s_c", "s_n", "s_o", "s_s", "s_halogen",
                    "s_aromatic", "s_ring_closures", "s_branches", "s_double", "s_triple",
                    "s_charged", "s_chiral", "s_linker", "s_mass"]


def fingerprint_width(kind: str) -> int:
    """Width of a fingerprint kind; unknown kinds are an error."""
    if kind not in FP_WIDTHS:
        raise ValueError(f"unsupported fingerprint type: {kind}")
    return FP_WIDTHS[kind]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_is_valid(text) -> Column:
    """A text can be featurized when it is non-blank and its brackets and
    parentheses balance."""
    t = _c(text)
    return (t.isNotNull() & (F.length(F.trim(t)) > 0)
            & (_cnt(t, r"\(") == _cnt(t, r"\)")) & (_cnt(t, r"\[") == _cnt(t, r"\]")))


def grams(text, q: int = GRAM) -> Column:
    """All overlapping q-character substrings of the digit-normalised text
    (whole text), in one linear regex pass: every match consumes exactly one
    character (code point, so surrogate pairs stay whole) and its look-ahead
    captures the q characters starting there."""
    norm = F.translate(_c(text), "123456789", "000000000")     # digits -> '0', no regex
    return F.coalesce(F.regexp_extract_all(norm, F.lit(f"(?s)(?=(.{{{q}}}))."), 1),
                      F.array().cast("array<string>"))


def with_gram_bits(df: DataFrame, text: str, nbits: int = DEFAULT_NBITS, q: int = GRAM,
                   out: str = "bits") -> DataFrame:
    """Add ``out``: array of bit ids, one per q-gram occurrence of the whole text.
    The gram array is materialised first (a lambda re-evaluates outer expressions
    per element)."""
    x = df.withColumn("__grams", grams(text, q))
    return x.withColumn(out, F.transform("__grams", lambda g: hash_bucket(g, nbits))).drop("__grams")


# Code points a task turns into grams at once.
PIECE_POINTS = 1 << 20


def gram_ids(points: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``q``-grams of an array of code points, as the position of one
    occurrence each, and for every position its gram's number."""
    n = points.size - q + 1
    alphabet = np.flatnonzero(np.bincount(points))
    width = max(1, int(alphabet.size - 1).bit_length())
    place = np.zeros(int(alphabet[-1]) + 1, np.uint64)
    place[alphabet] = np.arange(alphabet.size)
    code = place[points]
    ids, used = code[:n].copy(), width
    for i in range(1, q):
        if used + width > 64:                   # too wide: number what is there and go on
            ids = pd.factorize(ids)[0].astype(np.uint64)
            used = max(1, n.bit_length())
        ids = (ids << np.uint64(width)) | code[i:i + n]
        used += width
    gram, distinct = pd.factorize(ids)
    at = np.empty(distinct.size, np.int64)
    at[gram] = np.arange(n)
    return at, gram


# Grams a task keeps the hash of.
KNOWN_GRAMS = 1 << 20


def gram_hash(utf32: bytes) -> int:
    """The number a gram's bit comes from: the first 32 bits of the md5 of its UTF-8 bytes."""
    utf8 = utf32.decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.md5(utf8).digest()[:4], "big")


# Code points and pairs of neighbours a task gives numbers of their own.
KNOWN_POINTS = 1 << 9
KNOWN_PAIRS = 1 << 12


class GramBits:
    """Bits of the 4-grams a task has met, looked up by the numbers of the two pairs of code
    points a gram consists of. Full tables begin anew; a piece that has more code points or
    pairs than fit goes through :func:`gram_ids`."""

    def __init__(self, nbits: int):
        self.nbits = nbits
        self.clear()

    def clear(self) -> None:
        self.n_points, self.n_pairs = 0, 0
        self.point = np.full(0x110000, -1, np.int32)
        self.pair = np.full(KNOWN_POINTS * KNOWN_POINTS, -1, np.int32)
        self.bit = np.full(KNOWN_PAIRS * KNOWN_PAIRS, -1, np.int16 if self.nbits <= 1 << 15 else np.int64)

    def of(self, points: np.ndarray) -> np.ndarray | None:
        """The bit of the gram at each place, or None where the tables have no room."""
        bits = self._look_up(points)
        if bits is None:
            self.clear()
            bits = self._look_up(points)
        return bits

    def _look_up(self, points: np.ndarray) -> np.ndarray | None:
        point = self.point[points]
        if point.min() < 0:
            new = np.unique(points[point < 0])
            if self.n_points + new.size > KNOWN_POINTS:
                return None
            self.point[new] = np.arange(self.n_points, self.n_points + new.size)
            self.n_points += new.size
            point = self.point[points]
        two = point[:-1] * KNOWN_POINTS + point[1:]
        pair = self.pair[two]
        if pair.min() < 0:
            new = np.unique(two[pair < 0])
            if self.n_pairs + new.size > KNOWN_PAIRS:
                return None
            self.pair[new] = np.arange(self.n_pairs, self.n_pairs + new.size)
            self.n_pairs += new.size
            pair = self.pair[two]
        gram = pair[:-2] * KNOWN_PAIRS + pair[2:]
        bit = self.bit[gram]
        if bit.min() < 0:
            unknown = np.flatnonzero(bit < 0)
            new, first = np.unique(gram[unknown], return_index=True)
            self.bit[new] = [gram_hash(points[i:i + 4].tobytes()) % self.nbits for i in unknown[first].tolist()]
            bit = self.bit[gram]
        return bit


def piece_hits(texts: list[str], nbits: int, q: int, known: dict[bytes, int] | None = None,
               table: GramBits | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bit of every ``q``-gram occurrence of the texts, digits as '0';
    every distinct gram is hashed once, and not again while ``table`` (4-grams) or ``known`` holds it."""
    known = {} if known is None else known
    size = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where((points >= 49) & (points <= 57), np.uint32(48), points)
    if points.size < q:
        return (np.zeros(0, np.int64),) * 2
    doc = np.repeat(np.arange(size.size), size)
    inside = doc[:doc.size - q + 1] == doc[q - 1:]     # a gram across two texts is none
    bits = table.of(points) if table is not None and q == 4 else None
    if bits is not None:
        return doc[:inside.size][inside], bits[inside].astype(np.int64)
    at, gram = gram_ids(points, q)
    blob = points.tobytes()
    found = [blob[4 * i:4 * (i + q)] for i in at.tolist()]
    if len(known) > KNOWN_GRAMS:
        known.clear()
    for g in found:
        if g not in known:
            known[g] = gram_hash(g)
    bit = np.array([known[g] for g in found], np.int64) % nbits
    return doc[:inside.size][inside], bit[gram[inside]]


def piece_bits(texts: list[str], nbits: int, q: int, known: dict[bytes, int] | None = None,
               table: GramBits | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, bit, count)`` over all ``q``-grams of the texts."""
    doc, bit = piece_hits(texts, nbits, q, known, table)
    where, cnt = np.unique(doc * nbits + bit, return_counts=True)
    return where // nbits, where % nbits, cnt


def text_pieces(texts, q: int, limit: int = PIECE_POINTS):
    """Lists of ``(row, text)`` of at most ``limit`` code points; a longer text is cut so
    that each of its grams lies in one part."""
    piece, held = [], 0
    for row, t in enumerate(texts):
        for start in range(0, max(len(t) - q + 1, 1), limit):
            part = t[start:start + limit + q - 1]
            if piece and held + len(part) > limit:
                yield piece
                piece, held = [], 0
            piece.append((row, part))
            held += len(part)
    if piece:
        yield piece


def hashed_fingerprint(df: DataFrame, key: str = "key", text: str = "text",
                       nbits: int = DEFAULT_NBITS, q: int = GRAM) -> DataFrame:
    """FP1 long form ``(key, bit, cnt)``. Grams of whole texts are numbered and counted in
    Arrow batches, in pieces of bounded size, and each distinct gram of a piece is hashed once; at most ``nbits``
    rows per text are shuffled. Null and texts shorter than ``q`` have no row; rows of one key add up."""
    _ship_by_value()

    def run(batches):
        known, table = {}, GramBits(nbits) if q == 4 else None
        for batch in batches:
            rows = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
            texts = (batch.column(1)[i].as_py() for i in rows.tolist())
            for piece in text_pieces(texts, q):
                who, bit, cnt = piece_bits([t for _, t in piece], nbits, q, known, table)
                row = rows[np.array([r for r, _ in piece])[who]]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(bit.astype(np.int32)), pa.array(cnt.astype(np.int64))],
                                                 names=["__k", "bit", "cnt"])
    kind = df.select(key).schema[0].dataType
    fields = [T.StructField("__k", kind), T.StructField("bit", T.IntegerType()), T.StructField("cnt", T.LongType())]
    counts = df.select(F.col(key).alias("__k"), F.col(text).alias("__t")).mapInArrow(run, T.StructType(fields))
    return counts.groupBy(F.col("__k").alias(key), "bit").agg(F.sum("cnt").alias("cnt"))


def pattern_keys(df: DataFrame, key: str = "key", text: str = "text",
                 patterns: list[tuple[int, str, int]] | None = None) -> DataFrame:
    """FP2: ``(key, key_id)`` for every pattern whose match count reaches its
    minimum. The pattern table is evaluated as one projection per row."""
    pats = patterns or DEFAULT_PATTERNS
    hits = F.array(*[F.when(_cnt(F.col(text), r) >= F.lit(m), F.lit(i))
                     for i, r, m in pats])
    on = F.filter(hits, lambda x: x.isNotNull())
    return df.select(key, F.explode(on.cast("array<int>")).alias("key_id"))


def needed_literal(rx: str) -> str:
    """The longest plain text that every match of a regex must contain, as far as a simple
    reading tells: escapes count as their character; classes, groups, alternatives and
    what a quantifier may leave out end a run. Empty if nothing is sure."""
    if "|" in re.sub(r"\\.", "", rx) or "(?" in rx:
        return ""
    atom = r"(\\.|\[\^?\]?(?:\\.|[^\]\\])*\]|.)(?:([?*+]|\{[^}]*\})[?+]?)?"
    runs, now, depth = [], "", 0
    for x, many in re.findall(atom, rx, re.S):
        depth += (x == "(") - (x == ")")
        escaped = len(x) == 2 and x[0] == "\\" and not x[1].isalnum()
        plain = x[1] if escaped else x if len(x) == 1 and x not in "().^$" else ""
        if not plain or depth or many not in ("", "+"):
            runs.append(now)
            now = ""
            continue
        now += plain
        if many:                                 # once at least; what follows need not touch it
            runs.append(now)
            now = ""
    return max([*runs, now], key=len)


# Patterns up to which each text is searched for each needed literal.
FEW_PATTERNS = 256


def pattern_keys_from_table(df: DataFrame, patterns: DataFrame, key: str = "key", text: str = "text",
                            q: int = 3) -> DataFrame:
    """FP2 for a table ``(key_id int, regex string, min_count int)`` of any number of keys:
    ``(key, key_id)`` where a text has ``min_count`` matches or more.

    The needed literal of a pattern is cut to its first ``q`` characters; a text can match
    only if it holds them. With up to ``FEW_PATTERNS`` such patterns each text is searched for
    them; else the texts' distinct substrings of that length are joined with
    this index. A regex runs only on the candidates named, once per distinct text;
    patterns without such a literal run on all texts. The patterns are a user's list, so the
    driver reads them."""
    spark = df.sparkSession
    rows = [(r.key_id, r.regex, r.min_count, (needed_literal(r.regex) + "\0" * q)[:q].rstrip("\0")) for r in patterns.collect()]
    schema = "key_id int, __rx string, __least int, __need string"
    needing = [r for r in rows if len(r[3]) == q]
    indexed = F.broadcast(spark.createDataFrame(needing, schema))
    loose = [r for r in rows if len(r[3]) < q]
    dist = df.select(F.col(text).alias("__text")).where(F.col("__text").isNotNull()).distinct().withColumn("__pid", F.md5("__text"))
    if len(needing) <= FEW_PATTERNS:
        needed = F.array(*[F.lit(x) for x in sorted({r[3] for r in needing})]).cast("array<string>")
        named = dist.withColumn("__need", F.explode(needed)).where(F.col("__text").contains(F.col("__need")))
    else:
        held = F.array_distinct(F.regexp_extract_all("__text", F.lit(f"(?s)(?=(.{{{q}}}))."), 1))
        named = dist.withColumn("__need", F.explode(held))
    named = named.join(indexed, "__need").drop("__need")
    hit = named.where(F.expr("regexp_count(__text, __rx) >= __least")).select("__pid", "key_id")
    if loose:
        found = F.array(*[F.when(_cnt(F.col("__text"), rx) >= F.lit(least), F.lit(i)) for i, rx, least, _ in loose])
        hit = hit.union(dist.select("__pid", F.explode(F.filter(found, lambda x: x.isNotNull()).cast("array<int>")).alias("key_id")))
    owners = df.select(key, F.md5(F.col(text)).alias("__pid"))
    return salted_join(owners, hit, "__pid").select(key, "key_id")


def _literal(rx: str) -> str | None:
    """The plain text a regex matches when it has no metacharacters (escapes
    like ``\\(`` allowed), else None."""
    if any(ch in re.sub(r"\\.", "", rx) for ch in "[](){}|?*+.^$"):
        return None
    lit = re.sub(r"\\(.)", r"\1", rx)
    return lit if lit and lit.isascii() and lit.isprintable() else None


def _cnt(t: Column, rx: str) -> Column:
    """Non-overlapping match count. ASCII literal patterns are counted without
    the regex engine: removed bytes / pattern length (``replace`` also removes
    leftmost non-overlapping occurrences; ``octet_length`` is O(1) on UTF-8)."""
    lit = _literal(rx)
    if lit is not None:
        removed = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(lit), F.lit("")))
        return (removed / F.lit(len(lit))).cast("bigint")
    return F.regexp_count(t, F.lit(rx)).cast("bigint")


# Single characters that are tokens of their own (or start one: Br, Cl).
TOKEN_CHARS = "BCNOSPFIbcnosp().=#-+\\/:~@?>*$"


def _chars_in(t: Column, chars: str) -> Column:
    """Occurrences of any of the ASCII ``chars`` (one ``translate`` deletion)."""
    return (F.octet_length(t) - F.octet_length(F.translate(t, chars, ""))).cast("bigint")


def _regex_if(t: Column, marker: str, rx: str, otherwise: Column) -> Column:
    """The regex count only where ``marker`` occurs; exact ``otherwise`` elsewhere."""
    return F.when(t.contains(marker), F.regexp_count(t, F.lit(rx)).cast("bigint")).otherwise(otherwise)


# A bracket atom; and its symbol, after an isotope number.
BRACKET_RE = r"\[[^\]]+\]"
SYMBOL_RE = r"[A-Z][a-z]?|[a-z][a-z]?"


def split_brackets(df: DataFrame, text: str) -> DataFrame:
    """Add ``__outside``, the text with a space for each bracket atom, and
    ``__inside``, the symbols of the bracket atoms as ``<C><N>`` (``<>`` where
    an atom has none). Null counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    atoms = F.array_join(F.regexp_extract_all(t, F.lit(f"({BRACKET_RE})"), 1), "")
    symbols = F.regexp_replace(atoms, rf"\[[0-9]*({SYMBOL_RE})?[^\]]*\]", "<$1>")
    has = t.contains("[")
    return df.withColumn("__outside", F.when(has, F.regexp_replace(t, BRACKET_RE, " ")).otherwise(t)) \
        .withColumn("__inside", F.when(has, symbols).otherwise(F.lit("")))


def descriptor_columns(text: str) -> list[Column]:
    """FP4: token-class counts of a line-notation string, null/blank -> zeros,
    on rows prepared by :func:`split_brackets`.

    A bracket atom is one atom, of the element its symbol names; explicit
    hydrogen is no heavy atom. Ring closures, branches and bonds are counted
    outside brackets, chiral centres and charges per bracket atom.
    """
    t, out, inside = F.coalesce(F.col(text), F.lit("")), F.col("__outside"), F.col("__inside")
    bare = {x: _cnt(out, x) for x in ("B", "Br", "C", "Cl", "N", "O", "S", "F", "I", "P",
                                      "b", "c", "n", "o", "s", "p")}
    bare["C"], bare["B"] = bare["C"] - bare["Cl"], bare["B"] - bare["Br"]
    n = {x: c + _cnt(inside, f"<{x}>") for x, c in bare.items()}
    zero = F.lit(0).cast("bigint")
    ring = _chars_in(out, "0123456789") - _regex_if(out, "%", "%[0-9]{2}", zero)
    # tokens: without brackets every token is one alphabet character, a digit or
    # a '%dd' group; bracket atoms need the tokenizer itself
    tokens = _regex_if(t, "[", TOKEN_RE, _chars_in(out, TOKEN_CHARS) + ring)
    heavy = sum(bare.values(), _cnt(inside, "<") - _cnt(inside, "<>") - _cnt(inside, "<H>"))
    n_aro = n["b"] + n["c"] + n["n"] + n["o"] + n["s"] + n["p"]
    w = ATOMIC_WEIGHTS
    mass = (F.lit(w["C"]) * (n["C"] + n["c"]) + F.lit(w["N"]) * (n["N"] + n["n"])
            + F.lit(w["O"]) * (n["O"] + n["o"]) + F.lit(w["S"]) * (n["S"] + n["s"])
            + F.lit(w["P"]) * (n["P"] + n["p"]) + F.lit(w["B"]) * (n["B"] + n["b"])
            + F.lit(w["F"]) * n["F"] + F.lit(w["Cl"]) * n["Cl"] + F.lit(w["Br"]) * n["Br"]
            + F.lit(w["I"]) * n["I"])
    cols = [tokens, heavy, n["C"] + n["c"], n["N"] + n["n"], n["O"] + n["o"], n["S"] + n["s"],
            n["F"] + n["Cl"] + n["Br"] + n["I"], n_aro, ring,
            _cnt(out, r"\("), _cnt(out, "="), _cnt(out, "#"),
            _regex_if(t, "[", r"\[[^\]]*[+-][^\]]*\]", zero),
            _regex_if(t, "[", r"\[[^\]]*@[^\]]*\]", zero),
            F.when(t.contains("[Dy]"), 1).otherwise(0).cast("bigint"),
            F.round(mass, 6)]
    return [c.alias(n) for c, n in zip(cols, DESCRIPTOR_NAMES)]


def is_valid(text: str) -> bool:
    """:func:`text_is_valid` of one text."""
    return bool(text.strip(" ")) and text.count("(") == text.count(")") and text.count("[") == text.count("]")


def descriptor_values(text: str) -> list[float]:
    """:func:`descriptor_columns` of one text, the mass not rounded: single characters come
    from one count of its bytes, the tokenizer runs only where there are brackets."""
    out, inside = text, ""
    if "[" in text:
        out = re.sub(BRACKET_RE, " ", text)
        inside = re.sub(rf"\[[0-9]*({SYMBOL_RE})?[^\]]*\]", r"<\1>", "".join(re.findall(BRACKET_RE, text)))
    seen = np.bincount(np.frombuffer(out.encode("utf-8", "surrogatepass"), np.uint8), minlength=128).tolist()
    bare = {x: out.count(x) if len(x) > 1 else seen[ord(x)] for x in ("B", "Br", "C", "Cl", "N", "O", "S", "F", "I", "P",
                                                                      "b", "c", "n", "o", "s", "p")}
    bare["C"], bare["B"] = bare["C"] - bare["Cl"], bare["B"] - bare["Br"]
    n = {x: c + inside.count(f"<{x}>") for x, c in bare.items()}
    ring = sum(seen[48:58]) - len(re.findall("%[0-9]{2}", out))
    tokens = sum(1 for _ in re.finditer(TOKEN_RE, text)) if "[" in text else sum(seen[ord(x)] for x in TOKEN_CHARS) + ring
    heavy = sum(bare.values()) + inside.count("<") - inside.count("<>") - inside.count("<H>")
    w = ATOMIC_WEIGHTS
    mass = (w["C"] * (n["C"] + n["c"]) + w["N"] * (n["N"] + n["n"]) + w["O"] * (n["O"] + n["o"]) + w["S"] * (n["S"] + n["s"])
            + w["P"] * (n["P"] + n["p"]) + w["B"] * (n["B"] + n["b"]) + w["F"] * n["F"] + w["Cl"] * n["Cl"] + w["Br"] * n["Br"]
            + w["I"] * n["I"])
    return [tokens, heavy, n["C"] + n["c"], n["N"] + n["n"], n["O"] + n["o"], n["S"] + n["s"], n["F"] + n["Cl"] + n["Br"] + n["I"],
            n["b"] + n["c"] + n["n"] + n["o"] + n["s"] + n["p"], ring, seen[ord("(")], seen[ord("=")], seen[ord("#")],
            len(re.findall(r"\[[^\]]*[+-][^\]]*\]", text)), len(re.findall(r"\[[^\]]*@[^\]]*\]", text)), int("[Dy]" in text), mass]


def text_features(dist: DataFrame, tid: str, text: str, nbits: int = DEFAULT_NBITS, q: int = GRAM,
                  bits: bool = True, descriptors: bool = True) -> DataFrame:
    """``(tid, __bits, s_*...)`` of distinct texts: the bits of their grams as 0 and 1, one place
    a bit, and their descriptors, both in one pass over Arrow batches. An invalid text (X7) has
    zeros."""
    _ship_by_value()

    def run(batches):
        known, table = {}, GramBits(nbits) if q == 4 else None
        for batch in batches:
            texts = [t if is_valid(t) else "" for t in batch.column(1).to_pylist()]
            out = [batch.column(0)]
            if bits:
                on = np.zeros((len(texts), nbits), np.int8)
                for piece in text_pieces(texts, q):
                    doc, bit = piece_hits([t for _, t in piece], nbits, q, known, table)
                    on.ravel()[np.array([r * nbits for r, _ in piece])[doc] + bit] = 1
                ends = np.arange(len(texts) + 1, dtype=np.int32) * nbits
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(on.ravel())))
            if descriptors:
                values = np.array([descriptor_values(t) for t in texts], float).reshape(len(texts), len(DESCRIPTOR_NAMES))
                out += [pa.array(np.ascontiguousarray(v)) for v in values.T]
            yield pa.RecordBatch.from_arrays(out, names=names)
    fields = [T.StructField(tid, T.StringType())]
    fields += [T.StructField("__bits", T.ArrayType(T.ByteType()))] * bits
    fields += [T.StructField(n, T.DoubleType()) for n in DESCRIPTOR_NAMES if descriptors]
    names = [f.name for f in fields]
    found = dist.select(tid, text).mapInArrow(run, T.StructType(fields))
    return found.withColumn("s_mass", F.round("s_mass", 6)) if descriptors else found


def text_descriptors(df: DataFrame, key: str = "key", text: str = "text") -> DataFrame:
    """FP4 as a table ``(key, s_*...)`` (a projection, no shuffle)."""
    return split_brackets(df, text).select(key, *descriptor_columns(text))


# ----------------------------------------------------------------- FP3 kernel contract

KernelFn = Callable[[pd.DataFrame], pd.DataFrame]


def _ship_by_value() -> None:
    """Serialize this package's functions (the default kernel) with their code,
    so Python workers do not need ``screenlake`` on their import path."""
    import screenlake
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(screenlake)


def basic_text_kernel(pdf: pd.DataFrame) -> pd.DataFrame:
    """Default per-string kernel: whole-text counts computed in pandas."""
    s = pdf["text"].fillna("")
    return pd.DataFrame({"text": pdf["text"],
                         "k_chars": s.str.len().astype("int64"),
                         "k_spaces": s.str.count(" ").astype("int64"),
                         "k_digits": s.str.count("[0-9]").astype("int64"),
                         "k_valid": (s.str.strip().str.len() > 0)})


BASIC_KERNEL_SCHEMA = "text string, k_chars bigint, k_spaces bigint, k_digits bigint, k_valid boolean"


def distinct_featurize(df: DataFrame, text: str = "text", kernel: KernelFn = basic_text_kernel,
                       schema: str = BASIC_KERNEL_SCHEMA) -> DataFrame:
    """FP3/J4: run ``kernel`` once per distinct text and join the features back.

    ``kernel`` receives pandas batches with a ``text`` column and returns the
    ``schema`` columns (keeping ``text`` and the order of rows). It runs in Arrow
    batches on the executors; the distinct is a shuffle that spreads strings by hash.
    Rows meet their features by md5 of the text, salted for texts that many rows share.
    """
    dist = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).distinct()
    dist = dist.withColumn("__tid", F.md5("text"))
    _ship_by_value()

    def run(batches):
        for pdf in batches:
            yield kernel(pdf.drop(columns="__tid")).assign(__tid=pdf["__tid"].to_numpy()).drop(columns="text")

    kept = [f for f in T.StructType.fromDDL(schema) if f.name != "text"]
    feats = dist.mapInPandas(run, T.StructType([*kept, T.StructField("__tid", T.StringType())]))
    rows = df.withColumn("__tid", F.md5(F.col(text)))
    return salted_join(rows, feats, "__tid", "left").drop("__tid")


# ------------------------------------------------------------------ J5 group encoding

def group_onehot(df: DataFrame, groups: list[str], group: str = "grp",
                 prefix: str = "g_") -> DataFrame:
    """J5 one-hot: one 0/1 double column per configured group; unknown -> all zeros.
    A projection (``CASE`` per level), no join."""
    return df.select("*", *[F.when(F.col(group) == g, 1.0).otherwise(0.0).alias(f"{prefix}{g}")
                            for g in groups])


def group_label_encode(df: DataFrame, groups: list[str], group: str = "grp",
                       out: str = "group_idx") -> DataFrame:
    """J5 label encoding: position in the configured list, unknown -> -1."""
    e = F.lit(-1)
    for i, g in reversed(list(enumerate(groups))):
        e = F.when(F.col(group) == g, F.lit(i)).otherwise(e)
    return df.withColumn(out, e.cast("int"))


# ------------------------------------------------------------------ J3 / X2 feature table

def feature_names(nbits: int, groups: list[str], encoding: str = "onehot") -> list[str]:
    """Ordered feature names: fingerprint bits, descriptors, group columns
    (names derived from the columns actually produced)."""
    g = [f"g_{x}" for x in groups] if encoding == "onehot" else ["group_idx"]
    return [f"fp_{i}" for i in range(nbits)] + DESCRIPTOR_NAMES + g


def feature_table_long(df: DataFrame, groups: list[str], key: str = "key", text: str = "text",
                       group: str = "grp", nbits: int = DEFAULT_NBITS) -> DataFrame:
    """J3 in sparse COO form ``(key, feature_idx, value)``: fingerprint counts
    at ``0..nbits-1``, descriptors next, then the group one-hot. Zero entries
    are omitted. An invalid text (X7, :func:`text_is_valid`) has no features of
    its own, only its group's.

    One pass per distinct text (J4): its gram hits ``(bit, 1)`` and its
    descriptor values ``(nbits + j, v)`` are exploded together and summed per
    (text, feature) with map-side partial aggregation; the result is joined
    back to every row by md5(text)."""
    dist = (df.select(text).where(text_is_valid(text)).distinct()
            .withColumn("__tid", F.md5(F.col(text)))
            .withColumn("__grams", grams(text)))
    dist = split_brackets(dist, text)
    item = "struct<feature_idx:int,value:double>"
    fp_items = F.transform("__grams", lambda g: F.struct(hash_bucket(g, nbits).alias("feature_idx"),
                                                         F.lit(1.0).alias("value")))
    desc_items = F.array(*[F.struct(F.lit(nbits + j).alias("feature_idx"),
                                    c.cast("double").alias("value"))
                           for j, c in enumerate(descriptor_columns(text))]).cast(f"array<{item}>")
    per_text = (dist.select("__tid", F.explode(F.concat(fp_items.cast(f"array<{item}>"), desc_items))
                            .alias("__it"))
                .groupBy("__tid", F.col("__it.feature_idx").alias("feature_idx"))
                .agg(F.sum("__it.value").alias("value"))
                .where(F.col("value") != 0))
    rows = df.select(key, group, F.md5(F.col(text)).alias("__tid"))
    x = salted_join(rows, per_text, "__tid").select(key, F.col("feature_idx").cast("int"), "value")
    base = nbits + len(DESCRIPTOR_NAMES)
    gpairs = F.array(*[F.when(F.col(group) == g, F.lit(base + i)) for i, g in enumerate(groups)])
    oh = rows.select(key, F.explode(F.filter(gpairs, lambda v: v.isNotNull())).alias("feature_idx")) \
        .select(key, F.col("feature_idx").cast("int"), F.lit(1.0).alias("value"))
    return x.unionByName(oh)


def token_gain_topk(df: DataFrame, k: int = 20, key: str = "key", label: str = "label",
                    text: str = "text", nbits: int = DEFAULT_NBITS) -> DataFrame:
    """O1 (data form): the ``k`` fingerprint bits with the highest class lift
    ``P(label=1 | bit on) / P(label=1)``, ties by bit id. Bit presence per key
    comes from the partially aggregated long fingerprint; only the two overall
    totals reach the driver, and the top-k is the only limit."""
    from pyspark.sql import Window
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("p")).first()
    n_all, p_all = int(tot["n"]), int(tot["p"] or 0)
    base = (float(p_all) / float(n_all)) if n_all else 0.0
    on = hashed_fingerprint(df.select(key, text), key, text, nbits).select(key, "bit")
    per = (on.join(df.select(key, label), key)
           .groupBy("bit").agg(F.count(F.lit(1)).cast("bigint").alias("n_docs"),
                               F.sum(label).cast("bigint").alias("n_pos")))
    lift = F.try_divide(F.col("n_pos").cast("double") / F.col("n_docs").cast("double"),
                        F.lit(base))                     # null when there is no positive at all
    top = per.withColumn("lift", lift).orderBy(F.col("lift").desc(), "bit").limit(k)
    w = Window.orderBy(F.col("lift").desc(), "bit")
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


def text_descriptors_with_chunk(df: DataFrame, key: str = "key", text: str = "text",
                                chunk: str = "chunk_id") -> DataFrame:
    """FP4 keeping the chunk column (for chunked, resumable writers)."""
    return split_brackets(df, text).select(key, chunk, *descriptor_columns(text))
