"""DuckDB SQL fragments mirroring the Spark expressions (oracle side only)."""

from __future__ import annotations

from screenlake.operators.features import ATOMIC_WEIGHTS, DESCRIPTOR_NAMES, TOKEN_RE


def kh(expr: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || ({expr})::varchar)"


def hash_bucket(expr: str, nbits: int) -> str:
    return f"((('0x' || substr(md5({expr}), 1, 8))::bigint % {nbits})::int)"


def clip(expr: str) -> str:
    return (f"(CASE WHEN {expr} IS NULL OR isnan({expr}) THEN {expr} ELSE "
            f"least(greatest({expr}, 1e-6::double), 1.0::double - 1e-6::double) END)")


def rcount(t: str, rx: str) -> str:
    return f"len(regexp_extract_all({t}, '{rx}'))::bigint"


def valid(t: str) -> str:
    """A text that can be featurized: not blank, brackets and parentheses balanced."""
    return (f"coalesce(length(trim({t})) > 0 AND {rcount(t, chr(92) + '(')} = {rcount(t, chr(92) + ')')}"
            f" AND {rcount(t, chr(92) + '[')} = {rcount(t, chr(92) + ']')}, false)")


def descriptors(text: str) -> str:
    """Descriptors from the token list, token by token (the Spark side counts
    substrings of the text inside and outside brackets)."""
    t = f"coalesce({text}, '')"
    toks = f"regexp_extract_all({t}, '{TOKEN_RE}')"
    sym = (r"(CASE WHEN x[1] = '[' THEN regexp_extract(x, '^\[[0-9]*([A-Z][a-z]?|[a-z][a-z]?)', 1)"
           " ELSE x END)")

    def count(cond: str) -> str:
        return f"len([x for x in {toks} if {cond}])::bigint"

    def atoms(*symbols: str) -> str:
        return count(f"{sym} IN ({', '.join(repr(s) for s in symbols)})")

    elements = {"C": ("C", "c"), "N": ("N", "n"), "O": ("O", "o"), "S": ("S", "s"), "P": ("P", "p"),
                "B": ("B", "b"), "F": ("F",), "Cl": ("Cl",), "Br": ("Br",), "I": ("I",)}
    bare = ", ".join(repr(s) for v in elements.values() for s in v)
    heavy = count(f"CASE WHEN x[1] = '[' THEN {sym} NOT IN ('', 'H') ELSE x IN ({bare}) END")
    mass = " + ".join(f"{ATOMIC_WEIGHTS[e]}::double * {atoms(*v)}" for e, v in elements.items())
    cols = [f"len({toks})::bigint", heavy, *(atoms(*elements[e]) for e in "CNOS"),
            atoms("F", "Cl", "Br", "I"), atoms(*"bcnosp"),
            count("regexp_full_match(x, '%?[0-9]+')"), count("x = '('"), count("x = '='"), count("x = '#'"),
            count("x[1] = '[' AND (contains(x, '+') OR contains(x, '-'))"),
            count("x[1] = '[' AND contains(x, '@')"),
            f"(CASE WHEN contains({t}, '[Dy]') THEN 1 ELSE 0 END)::bigint", f"round({mass}, 6)"]
    return ", ".join(f"{c} AS {nm}" for c, nm in zip(cols, DESCRIPTOR_NAMES))


def grams(text: str, q: int = 4) -> str:
    """Rows ``(key, gram)`` for a relation with columns key, text."""
    return (f"SELECT key, substring(norm, i, {q}) AS gram FROM (SELECT key, norm, "
            f"unnest(generate_series(1, length(norm) - {q - 1})) AS i FROM (SELECT key, "
            f"regexp_replace({text}, '[0-9]', '0', 'g') AS norm FROM src) WHERE length(norm) >= {q})")
