"""The Merkle manifest's rows as DuckDB SQL, level by level."""

from __future__ import annotations

import string

# Levels above the leaves of a source and above the sources that the SQL can express.
LEAF_LEVELS, SOURCE_LEVELS = 6, 3


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_framed(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
# One entry per bit of the id's decimal digits; the first of each eight brings the next character.
_BITS = "flatten([[ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(doc_id::VARCHAR, '')])"
_CRC = (
    f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_BITS}),"
    " lambda crc, e: xor(xor(crc, e) >> 1, 3988292384 * (xor(crc, e) & 1))), 4294967295)"
)


def _tree(name: str, levels: int) -> list[str]:
    """CTEs name0 .. (owner, n, idx, digest) grow from name0; name0s .. hold each node's siblings."""
    parts = []
    for k in range(levels):
        parts.append(
            f"{name}{k}s AS (SELECT owner, idx, digest, n,"
            f" string_agg(digest, '') OVER (run ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,"
            f" string_agg(digest, '') OVER (run ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r"
            f" FROM {name}{k} WHERE n > {16**k} WINDOW run AS (PARTITION BY owner, idx // 16))"
        )
        parts.append(
            f"{name}{k + 1} AS (SELECT owner, any_value(n) AS n, idx // 16 AS idx, sha256(string_agg(digest, '' ORDER BY idx)) AS digest"
            f" FROM {name}{k} WHERE n > {16**k} GROUP BY owner, idx // 16)"
        )
    tops = " UNION ALL ".join(f"SELECT owner, digest FROM {name}{k} WHERE n <= {16**k}" + (f" AND n > {16 ** (k - 1)}" if k else "") for k in range(levels + 1))
    return [*parts, f"{name}_top AS ({tops})"]


def _steps(alias: str, levels: int, fold: str) -> tuple[str, str]:
    """Siblings of all levels in a row, and the digest folded up through them."""
    proof = []
    for k in range(levels):
        left, right = f"coalesce({alias}{k}.l, '')", f"coalesce({alias}{k}.r, '')"
        proof.append(f"{left} || {right}")
        fold = f"CASE WHEN {alias}{k}.idx IS NULL THEN {fold} ELSE sha256({left} || ({fold}) || {right}) END"
    return " || ".join(proof), fold


def _joins(alias: str, name: str, levels: int, owner: str, rank: str) -> str:
    return " ".join(f"LEFT JOIN {name}{k}s {alias}{k} ON {alias}{k}.owner = {owner} AND {alias}{k}.idx = {rank} // {16**k}" for k in range(levels))


def merkle_sql() -> str:
    leaf_proof, leaf_fold = _steps("a", LEAF_LEVELS, "coalesce(tampered, leaf)")
    source_proof, source_fold = _steps("b", SOURCE_LEVELS, "half")
    steps = [
        f"hashed AS (SELECT doc_id, coalesce('=' || source, '') AS owner, {_leaf('text')} AS leaf,"
        f" CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(_LOWER)} END AS tampered FROM documents)",
        "docs AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank,"
        " count(*) OVER (PARTITION BY owner) AS n FROM hashed)",
        "leaf0 AS (SELECT owner, n, rank AS idx, leaf AS digest FROM docs)",
        *_tree("leaf", LEAF_LEVELS),
        "ordered AS (SELECT owner AS source_key, digest, row_number() OVER (ORDER BY owner) - 1 AS rank, count(*) OVER () AS n FROM leaf_top)",
        "source0 AS (SELECT '' AS owner, n, rank AS idx, digest FROM ordered)",
        *_tree("source", SOURCE_LEVELS),
        f"lower_half AS (SELECT d.doc_id, d.leaf, d.owner AS doc_owner, {leaf_proof} AS lower_proof, {leaf_fold} AS half"
        f" FROM docs d {_joins('a', 'leaf', LEAF_LEVELS, 'd.owner', 'd.rank')})",
        f"whole AS (SELECT h.doc_id, h.leaf, o.digest AS subroot, t.digest AS root, sha256(lower_proof || {source_proof}) AS proof_sha256, {source_fold} AS folded_root"
        f" FROM lower_half h JOIN ordered o ON o.source_key = h.doc_owner CROSS JOIN source_top t {_joins('b', 'source', SOURCE_LEVELS, repr(''), 'o.rank')})",
    ]
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM whole"
