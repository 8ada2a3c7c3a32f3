"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH sizes AS (
    SELECT doc_id, source,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        ('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, text)), 1, 12))::BIGINT AS point
    FROM documents
), weighed AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
            WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
        (sum(sum(size)) OVER ())::DOUBLE * 1.5::DOUBLE AS total,
        (sum(size) * 2)::DOUBLE AS most
    FROM sizes GROUP BY source
), levels AS (
    SELECT *,
        (total - coalesce(sum(most) OVER before, 0.0::DOUBLE))
            / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER before, 0.0::DOUBLE))
            * weight > most AS stops
    FROM weighed
    WINDOW before AS (ORDER BY most / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
        CASE WHEN stops THEN most ELSE
            (total - sum(CASE WHEN stops THEN most ELSE 0.0::DOUBLE END) OVER ()) * weight
            / sum(CASE WHEN stops THEN 0.0::DOUBLE ELSE weight END) OVER () END AS target
    FROM levels
), budgets AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
    FROM targets
), sums AS (
    SELECT doc_id, size, source_size, target, whole, target - whole * source_size AS budget,
        sum(size) OVER (PARTITION BY s.source ORDER BY point) AS upto,
        sum(size) OVER (PARTITION BY s.source, point) AS inside
    FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies
FROM (
    SELECT *, (whole::BIGINT + CASE WHEN budget > 0 AND (upto <= budget
        OR (upto - inside <= budget AND abs(upto - budget) < abs(upto - inside - budget)))
        THEN 1 ELSE 0 END)::BIGINT AS copies
    FROM sums
)
"""


def crc32(text: str) -> str:
    """SQL of the unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([xor(state, code), 0, 0, 0, 0, 0, 0, 0, 0],"
    step += " lambda rest, bit: xor(rest >> 1, (rest & 1) * 3988292384))"
    codes = f"list_transform(string_split({text}, ''), lambda letter: ord(letter)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda state, code: {step}), 4294967295)"


def field(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def manifest_leaf(text: str) -> str:
    values = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256(concat({', '.join(map(field, values))}))"


def _levels(name: str, levels: int) -> str:
    """Common tables of the runs on each level above ``{name}_0`` (tree, index, digest, width)."""
    parts = []
    for k in range(levels):
        parts.append(f"""{name}_run_{k} AS MATERIALIZED (
    SELECT tree, index // 8 AS up, any_value(width) AS width,
        list(digest ORDER BY index) AS run
    FROM {name}_{k} WHERE width > 1 GROUP BY ALL
), {name}_{k + 1} AS MATERIALIZED (
    SELECT tree, up AS index, sha256(array_to_string(run, '')) AS digest, (width + 7) // 8 AS width
    FROM {name}_run_{k}
), """)
    return "".join(parts)


def _climb(name: str, source: str, kept: str, levels: int) -> str:
    """Common tables that carry ``proof`` and ``node`` of ``source`` through all levels."""
    parts = []
    for k in range(levels):
        below = source if k == 0 else f"{name}_up_{k - 1}"
        slot = f"b.index // {8**k} % 8"
        left = f"array_to_string(run[1:{slot}], '')"
        right = f"array_to_string(run[{slot} + 2:], '')"
        parts.append(f"""{name}_up_{k} AS MATERIALIZED (
    SELECT {kept}, b.tree, b.index,
        CASE WHEN run IS NULL THEN proof ELSE concat(proof, {left}, {right}) END AS proof,
        CASE WHEN run IS NULL THEN node ELSE sha256(concat({left}, node, {right})) END AS node
    FROM {below} b LEFT JOIN {name}_run_{k} r
        ON r.tree = b.tree AND r.up = b.index // {8 ** (k + 1)}
), """)
    return "".join(parts)


# So many levels of eight hold 16 million rows of a language, and 512 languages.
ROW_LEVELS, LANG_LEVELS = 8, 3

MANIFEST = f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, lang, {manifest_leaf("text")} AS leaf,
        CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0
            THEN {manifest_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
            ELSE {manifest_leaf("text")} END AS copy
    FROM documents
), langs AS (
    SELECT lang, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree, count(*) AS width
    FROM leaves GROUP BY lang
), rows_0 AS MATERIALIZED (
    SELECT doc_id, leaf, copy, tree, width, leaf AS digest,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS index
    FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang
), {_levels("rows", ROW_LEVELS)}subroots AS (
    {" UNION ALL ".join(f"SELECT tree, digest FROM rows_{k} WHERE width = 1" for k in range(ROW_LEVELS + 1))}
), langs_0 AS MATERIALIZED (
    SELECT 0 AS tree, tree AS index, digest, (SELECT count(*) FROM subroots) AS width FROM subroots
), {_levels("langs", LANG_LEVELS)}roots AS (
    {" UNION ALL ".join(f"SELECT digest FROM langs_{k} WHERE width = 1" for k in range(LANG_LEVELS + 1))}
), started AS (
    SELECT doc_id, leaf, tree, index, '' AS proof, copy AS node FROM rows_0
), {_climb("rows", "started", "doc_id, leaf", ROW_LEVELS)}crossed AS (
    SELECT doc_id, leaf, subroots.digest AS subroot, 0 AS tree, tree AS index, proof, node
    FROM rows_up_{ROW_LEVELS - 1} JOIN subroots USING (tree)
), {_climb("langs", "crossed", "doc_id, leaf, subroot", LANG_LEVELS)}done AS (
    SELECT * FROM langs_up_{LANG_LEVELS - 1}, roots
)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, node AS folded_root,
    node = digest AS verified
FROM done
"""

TRIE = f"""
WITH items AS (
    SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
            || coalesce(text, '')) AS item,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS words
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list({{'item': item, 'words': words}} ORDER BY turn NULLS FIRST, item) AS turns,
        {crc32("conv_id::VARCHAR")} % 4 AS shared
    FROM items GROUP BY conv_id
), rebuilt AS MATERIALIZED (
    SELECT o.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, o.shared),
        list_slice(o.turns, o.shared + 1, len(o.turns))) AS turns
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20
), paths AS MATERIALIZED (
    SELECT conv_id, depth, depth = len(turns) AS ends,
        CASE WHEN depth = 0 THEN 0 ELSE turns[depth].words END AS words,
        sha256(array_to_string(list_transform(turns[1:depth], lambda x: x.item), '')) AS node,
        CASE WHEN depth > 0 THEN
            sha256(array_to_string(list_transform(turns[1:depth - 1], lambda x: x.item), '')) END AS up
    FROM rebuilt, unnest(range(0, len(turns)::BIGINT + 1)) AS places(depth)
), nodes AS MATERIALIZED (
    SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * any_value(words) AS gain,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
            AS ends_sha256
    FROM paths GROUP BY depth, node
), children AS (
    SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes GROUP BY ALL
), totals AS (
    SELECT p.depth, p.node, sum(v.gain)::BIGINT AS saved_tokens,
        count(*) FILTER (NOT EXISTS (FROM children c WHERE c.depth = v.depth AND c.node = v.node))
            AS n_leaves
    FROM nodes v JOIN paths p ON p.conv_id = v.conv_id AND p.depth <= v.depth
    GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs,
    coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN totals USING (depth, node) LEFT JOIN children USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.up
"""

ORACLES = {"op5_mixing": MIXING, "op12_prefix_trie": TRIE, "op13_manifest": MANIFEST}
