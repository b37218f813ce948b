"""Registered queries of the training-data operators and their SQL (where SQL can express them)."""

from __future__ import annotations

from tagwise.llm.balltree import op5_exact_top_k
from tagwise.llm.bpe import op6_bpe_encode_decode
from tagwise.llm.density import op4_html_extraction
from tagwise.llm.langid import op9_language_id
from tagwise.llm.ledger import op7_secret_scans
from tagwise.llm.lexical import op12_ranked_lexical_search
from tagwise.llm.merkle import op11_merkle_manifest
from tagwise.llm.packing import op2_best_fit_packing
from tagwise.llm.phrases import op13_document_fingerprints
from tagwise.llm.quality import op1_quality_classifier
from tagwise.llm.simhash import op10_simhash_near_dedup
from tagwise.llm.suffix import op8_suffix_array_dedup
from tagwise.llm.vectors import op3_embedding_near_dedup

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_html_extraction": op4_html_extraction,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_bpe_encode_decode": op6_bpe_encode_decode,
    "op7_secret_scans": op7_secret_scans,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_language_id": op9_language_id,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_document_fingerprints": op13_document_fingerprints,
}



def _merkle_sql(levels: int = 15) -> str:
    """Trees level by level; ``levels`` bounds the SQL's trees to 3^levels leaves, the operator's are not bounded."""
    tree = lambda name, first: [
        f"{name}0 AS MATERIALIZED ({first})",
        *[
            f"""{name}{i} AS MATERIALIZED (
  SELECT tree, pos // 3 AS pos, (n + 2) // 3 AS n,
    CASE WHEN n = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
  FROM {name}{i - 1} GROUP BY tree, pos // 3, n)"""
            for i in range(1, levels + 1)
        ],
    ]

    def ways(name: str) -> str:
        """For each node of each level: its siblings with '*' in its own place."""
        each = [
            f"""SELECT tree, pos, {i} AS level, n,
  coalesce(string_agg(node, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') || '*' ||
  coalesce(string_agg(node, '' ORDER BY pos) OVER (PARTITION BY tree, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS around
FROM {name}{i}"""
            for i in range(levels)
        ]
        return f"{name}_ways AS MATERIALIZED (SELECT tree, pos, level, around FROM ({' UNION ALL '.join(each)}) WHERE n > 1)"

    powers = ", ".join(str(3**i) for i in range(levels))
    path = f"""(SELECT tree, pos, unnest(range({levels})) AS level, pos // unnest([{powers}]) AS up FROM"""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {field(text)})"
    crc = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""
    parts = [
        f"""docs AS MATERIALIZED (
  SELECT doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS asked
  FROM documents)""",
        """named AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM docs)""",
        *tree("own", "SELECT tree, pos, n, leaf AS node FROM named"),
        *tree("top", f"SELECT CAST(0 AS BIGINT) AS tree, tree AS pos, count(*) OVER () AS n, node FROM own{levels}"),
        ways("own"),
        ways("top"),
        f"""own_path AS (
  SELECT p.tree, p.pos, array_agg(around ORDER BY p.level) AS a
  FROM {path} own0) p JOIN own_ways w ON w.tree = p.tree AND w.level = p.level AND w.pos = p.up GROUP BY p.tree, p.pos)""",
        f"""top_path AS (
  SELECT p.pos AS tree, array_agg(around ORDER BY p.level) AS a
  FROM {path} top0) p JOIN top_ways w ON w.level = p.level AND w.pos = p.up GROUP BY p.pos)""",
        f"""proofs AS (
  SELECT d.*, s.node AS subroot, (SELECT node FROM top{levels}) AS root, coalesce(o.a, []) || coalesce(t.a, []) AS a
  FROM named d JOIN top0 s ON s.pos = d.tree
  LEFT JOIN own_path o ON o.tree = d.tree AND o.pos = d.pos LEFT JOIN top_path t ON t.tree = d.tree)""",
        """folded AS (SELECT *, list_reduce(list_prepend(asked, a), lambda x, y: sha256(replace(y, '*', x))) AS folded_root FROM proofs)""",
    ]
    return f"""WITH {', '.join(parts)}
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(a, ''), '*', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folded"""


# SQL for the operators that it can express on whole tables; the others are tested against brute force in tests/llm
ORACLE: dict[str, str] = {
    # all pairs by integer inner product: the queries against all rows
    "op5_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op11_merkle_manifest": _merkle_sql(),
    # every item against all documents, term by term
    "op12_ranked_lexical_search": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS key, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), own AS MATERIALIZED (SELECT key, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM own),
tf AS MATERIALIZED (SELECT key, term, count(*) AS tf FROM (SELECT key, unnest(terms) AS term FROM own) GROUP BY key, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, n_docs),
item AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL
), s AS (
  SELECT i.item_id, i.text, o.key, o.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * o.n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item i JOIN w USING (term) JOIN tf t USING (term) JOIN own o USING (key), total GROUP BY i.item_id, i.text, o.key, o.doc_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
""",
}
