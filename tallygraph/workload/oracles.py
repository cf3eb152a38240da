"""The same results in plain SQL."""

from tallygraph.workload.queries import FEATURES, GROUPS, TERMS

PADDING = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def words(source: str, id_col: str) -> str:
    """Common tables ``tokens``, ``counts`` and ``corpus`` of one text table."""
    return f"""
    pieces AS (
        SELECT {id_col} AS doc_id,
               lower(unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{Nd}}_][\\p{{L}}\\p{{Nd}}_\\p{{Mn}}]*'))) AS word
        FROM {source}
    ),
    tokens AS (SELECT doc_id, word FROM pieces WHERE regexp_full_match(word, '[a-z]+')),
    counts AS (SELECT word, doc_id, count(*) AS n FROM tokens GROUP BY word, doc_id),
    corpus AS (SELECT count(DISTINCT {id_col}) AS n_docs FROM {source})
    """


FREQUENCIES = "frequencies AS (SELECT word, count(*) AS df FROM counts GROUP BY word)"

SCORES = f"""
    {FREQUENCIES},
    scores AS (
        SELECT counts.word, doc_id, (log10(n) + 1) * log10(1 + n_docs / df) AS tfidf
        FROM counts JOIN frequencies ON counts.word = frequencies.word CROSS JOIN corpus
    )
"""

DOCUMENT_WORDS = words("documents", "doc_id")
CONVERSATION_WORDS = words("conversations", "conv_id")


def literals(terms: list[str]) -> str:
    return ", ".join(f"'{term.lower()}'" for term in terms)


def hits(source: str, terms: str) -> str:
    return f"""
    WITH {source}, {SCORES}
    SELECT doc_id, round(sum(tfidf), 6) AS score FROM scores WHERE word IN ({terms}) GROUP BY doc_id
    """


BASKETS = """
    baskets AS (
        SELECT l_orderkey, l_partkey, l_suppkey, l_linestatus,
               lead(l_partkey) OVER (
                   PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS next_part
        FROM lineitem
    )
"""

BASKET_EDGES = f"""
    {BASKETS},
    edges AS (
        SELECT l_partkey AS src, next_part AS dst, count(*) AS multiplicity
        FROM baskets WHERE next_part IS NOT NULL GROUP BY ALL
    )
"""

PART_NODES = "nodes AS (SELECT p_partkey AS id FROM part), lines AS (SELECT count(*) AS n FROM part)"

WIKI_LINES = f"""
    {BASKETS},
    dump AS (
        SELECT '<page><title> Part ' || l_partkey || ' </title><text xml:space="preserve">of [[Supplier '
               || l_suppkey || ']] ' || coalesce('[[Part ' || next_part || ']] ', '')
               || '[[]] [[ ]] [[ Order ' || l_orderkey || '|' || l_linestatus || ' ]]</text></page>' AS value
        FROM baskets
        UNION ALL
        SELECT '<title>Supplier ' || s_suppkey || '</title><text>[[Nation ' || s_nationkey
               || ']]</text> [[Part 1]]' FROM supplier
        UNION ALL
        SELECT '<title>Nation ' || n_nationkey || '</title><text>[[Nation ' || n_nationkey
               || ']] [[Region:[[' || n_regionkey || ']] x]] [[Part ' || n_nationkey || ']]</text>' FROM nation
        UNION ALL
        SELECT 'untitled <text>[[Nation ' || r_regionkey || ']]</text>' FROM region
        UNION ALL
        SELECT '<title>Customer ' || c_custkey || '</title>' FROM customer
        UNION ALL
        SELECT '' FROM orders
    )
"""

WIKI_PAGES = f"""
    {WIKI_LINES},
    parsed AS (
        SELECT CASE WHEN regexp_matches(value, '<title>(.+?)</title>')
                    THEN trim(regexp_extract(value, '<title>(.+?)</title>', 1), {PADDING})
                    ELSE 'null' END AS title,
               regexp_extract_all(regexp_extract(value, '<text(.*?)>(.*?)</text>', 0), '\\[\\[.*?\\]\\]') AS spans
        FROM dump WHERE value <> ''
    ),
    spans AS (SELECT title, unnest(spans) AS span FROM parsed),
    bare AS (SELECT title, trim(replace(replace(span, '[[', ''), ']]', ''), {PADDING}) AS link FROM spans),
    links AS (SELECT title, link FROM bare WHERE link <> '')
"""

WIKI_GRAPH = f"""
    {WIKI_PAGES},
    edges AS (SELECT title AS src, link AS dst, count(*) AS multiplicity FROM links GROUP BY ALL),
    nodes AS (SELECT DISTINCT title AS id FROM parsed),
    lines AS (SELECT count(*) AS n FROM dump)
"""


def steps(graph: str, count: int, order: str = "") -> str:
    """One materialized table per step."""
    tables = [
        f"""{graph},
    stored_edges AS MATERIALIZED (SELECT * FROM edges),
    degrees AS MATERIALIZED (SELECT src, sum(multiplicity) AS degree FROM stored_edges GROUP BY src),
    r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / n AS rank FROM nodes CROSS JOIN lines)"""
    ]
    for step in range(count):
        tables.append(f"""
    r{step + 1} AS MATERIALIZED (
        SELECT id, (1.0::DOUBLE - 0.85::DOUBLE) + 0.85::DOUBLE * coalesce(received, 0) AS rank
        FROM r{step} LEFT JOIN (
            SELECT dst, sum(rank / degree * multiplicity) AS received
            FROM stored_edges
            JOIN degrees ON degrees.src = stored_edges.src
            JOIN r{step} ON id = stored_edges.src
            GROUP BY dst
        ) ON dst = id
    )""")
    return f"WITH {','.join(tables)} SELECT id, round(rank, 6) AS rank FROM r{count} {order}"


def mean_sum(a: str, b: str) -> str:
    return f"round(sum({a} * {b}) / count(*), 4)"


def normal_cells() -> str:
    terms = {"intercept": "1.0::DOUBLE", **{name: name for name in FEATURES}}
    cells = [
        f"SELECT '{row}' AS row_term, '{col}' AS col_term, {mean_sum(a, b)} AS mean FROM lineitem"
        for row, a in terms.items()
        for col, b in [*terms.items(), ("l_extendedprice", "l_extendedprice")]
    ]
    return " UNION ALL ".join(cells)


def centred(xs: list[str]) -> str:
    """Means, and covariances by pair of positions: ``c12`` of the first two features,
    ``c1y`` of the first one and the response."""
    y = "l_extendedprice"
    cells = [f"avg({y}) AS my"]
    for i, x in enumerate(xs, 1):
        cells.append(f"avg({x}) AS m{i}")
        cells.append(f"covar_pop({x}, {y}) AS c{i}y")
        cells += [f"covar_pop({x}, {other}) AS c{i}{j}" for j, other in enumerate(xs, 1)]
    return f"SELECT {', '.join(cells)} FROM lineitem"


def determinant(rows: list[list[str]]) -> str:
    """Laplace expansion along the first row."""
    if len(rows) == 1:
        return rows[0][0]
    terms = []
    for j, cell in enumerate(rows[0]):
        minor = [row[:j] + row[j + 1 :] for row in rows[1:]]
        terms.append(f"{'-' if j % 2 else '+'} {cell} * ({determinant(minor)})")
    return " ".join(terms)


def least_squares(xs: list[str]) -> str:
    """Cramer's rule on the covariances."""
    positions = range(1, len(xs) + 1)
    matrix = [[f"c{i}{j}" for j in positions] for i in positions]
    slopes = []
    for k in positions:
        replaced = [[f"c{i}y" if j == k else f"c{i}{j}" for j in positions] for i in positions]
        slopes.append(f"({determinant(replaced)}) / ({determinant(matrix)}) AS b{k}")
    solved = f"WITH sums AS ({centred(xs)}), solved AS (SELECT *, {', '.join(slopes)} FROM sums)"
    intercept = " - ".join(["my", *(f"b{k} * m{k}" for k in positions)])
    rows = [f"SELECT 'intercept' AS term, round({intercept}, 6) AS beta FROM solved"]
    rows += [f"SELECT '{x}' AS term, round(b{k}, 6) AS beta FROM solved" for k, x in enumerate(xs, 1)]
    return f"{solved} {' UNION ALL '.join(rows)}"


ORACLES: dict[str, str] = {
    "corpus_size": "SELECT count(DISTINCT doc_id) AS n_docs FROM documents",
    "tokenize": f"WITH {DOCUMENT_WORDS} SELECT doc_id, word FROM tokens",
    "doc_word_count": f"WITH {DOCUMENT_WORDS} SELECT word, doc_id, n FROM counts",
    "conversation_word_count": f"WITH {CONVERSATION_WORDS} SELECT word, doc_id, n FROM counts",
    "term_frequency": f"WITH {DOCUMENT_WORDS} SELECT word, doc_id, round(log10(n) + 1, 6) AS tf FROM counts",
    "document_frequency": f"WITH {DOCUMENT_WORDS}, {FREQUENCIES} SELECT word, df FROM frequencies",
    "inverse_document_frequency": f"""
        WITH {DOCUMENT_WORDS}, {FREQUENCIES}
        SELECT word, df, round(log10(1 + n_docs / df), 6) AS idf FROM frequencies CROSS JOIN corpus""",
    "tfidf": f"WITH {DOCUMENT_WORDS}, {SCORES} SELECT word, doc_id, round(tfidf, 6) AS tfidf FROM scores",
    "conversation_tfidf": f"""
        WITH {CONVERSATION_WORDS}, {SCORES}
        SELECT word, doc_id, round(tfidf, 6) AS tfidf FROM scores""",
    "search_any": hits(DOCUMENT_WORDS, literals(TERMS)),
    "search_by_document": hits(CONVERSATION_WORDS, literals(["que", "la"])) + " ORDER BY doc_id",
    "search_top": hits(DOCUMENT_WORDS, literals(TERMS)) + " ORDER BY score DESC, doc_id LIMIT 10",
    "search_term_table": hits(
        DOCUMENT_WORDS,
        f"WITH {words('benchmark', 'item_id')} SELECT word FROM tokens",
    ),
    "search_stored_scores": hits(DOCUMENT_WORDS, literals(["les", "und", "that"])),
    "page_titles": f"""
        WITH html_lines AS (SELECT page_id, unnest(string_split(html, chr(10))) AS value FROM pages)
        SELECT page_id, trim(regexp_extract(value, '<title>(.+?)</title>', 1), {PADDING}) AS title
        FROM html_lines WHERE regexp_matches(value, '<title>(.+?)</title>')""",
    "line_count": f"WITH {WIKI_LINES} SELECT count(*) AS n_lines FROM dump",
    "page_links": f"WITH {WIKI_PAGES} SELECT title, link FROM links",
    "page_nodes": f"WITH {WIKI_PAGES} SELECT DISTINCT title AS id FROM parsed",
    "link_edges": f"WITH {WIKI_GRAPH} SELECT src, dst, multiplicity FROM edges",
    "link_out_degree": f"""
        WITH {WIKI_GRAPH} SELECT src, sum(multiplicity)::BIGINT AS out_degree FROM edges GROUP BY src""",
    "known_links": f"""
        WITH {WIKI_GRAPH} SELECT src, dst, multiplicity FROM edges WHERE dst IN (SELECT id FROM nodes)""",
    "initial_rank": f"""
        WITH {WIKI_GRAPH} SELECT id, round(1.0::DOUBLE / n, 12) AS rank FROM nodes CROSS JOIN lines""",
    "edge_multiplicity": f"WITH {BASKET_EDGES} SELECT src, dst, multiplicity FROM edges",
    "out_degree": f"""
        WITH {BASKET_EDGES} SELECT src, sum(multiplicity)::BIGINT AS out_degree FROM edges GROUP BY src""",
    "pagerank_one_step": steps(f"{BASKET_EDGES}, {PART_NODES}", 1),
    "pagerank_10": steps(f"{BASKET_EDGES}, {PART_NODES}", 10),
    "pagerank_top100": steps(f"{BASKET_EDGES}, {PART_NODES}", 10, "ORDER BY round(rank, 6) DESC, id LIMIT 100"),
    "wiki_pagerank": steps(WIKI_GRAPH, 10),
    "wiki_pagerank_ranked": steps(WIKI_GRAPH, 10, "ORDER BY round(rank, 6) DESC, id"),
    "wiki_pagerank_text_files": steps(WIKI_GRAPH, 10),
    "normal_matrix": normal_cells(),
    "ols_simple": least_squares(FEATURES[:1]),
    "ols_two_features": least_squares(FEATURES[:2]),
    "ols_three_features": least_squares(FEATURES),
    "ols_stored_betas": least_squares(FEATURES),
    "ols_from_csv": least_squares(FEATURES[:2])
    .replace("'l_quantity'", "'x1'")
    .replace("'l_discount'", "'x2'"),
    "ols_group_indicators": f"""
        WITH means AS (SELECT l_orderkey % {GROUPS} AS k, avg(l_extendedprice) AS mean FROM lineitem GROUP BY 1)
        SELECT CASE WHEN k = 0 THEN 'intercept' ELSE 'g' || k END AS term,
               round(CASE WHEN k = 0 THEN mean ELSE mean - (SELECT mean FROM means WHERE k = 0) END, 4) AS beta
        FROM means""",
    # Fitted on the quantity and the price, which are well apart, and put in the other terms.
    "ols_nearly_dependent": """
        WITH rows AS (
            SELECT l_quantity::DOUBLE AS q, l_extendedprice::DOUBLE AS p,
                   l_extendedprice::DOUBLE * (1 - l_discount::DOUBLE) AS y
            FROM lineitem),
        sums AS (
            SELECT avg(q) AS mq, avg(p) AS mp, avg(y) AS my, covar_pop(q, q) AS qq, covar_pop(p, p) AS pp,
                   covar_pop(q, p) AS qp, covar_pop(q, y) AS qy, covar_pop(p, y) AS py
            FROM rows),
        plain AS (
            SELECT *, (qy * pp - py * qp) / (qq * pp - qp * qp) AS bq, (py * qq - qy * qp) / (qq * pp - qp * qp) AS bp
            FROM sums),
        turned AS (
            SELECT bp * 1e8 AS traced, bq - bp * 1e8 AS shifted, my - bq * mq - bp * mp AS constant FROM plain)
        SELECT 'intercept' AS term, round((constant - shifted * 1e6) / 1e14, 6) AS beta FROM turned
        UNION ALL SELECT 'shifted', round(shifted / 1e8, 6) FROM turned
        UNION ALL SELECT 'traced', round(traced / 1e8, 6) FROM turned""",
    "bad_csv_records": """
        SELECT CASE WHEN l_linenumber = 2 THEN l_orderkey || ',' || l_linenumber
                    ELSE l_orderkey || ',none,' || l_linenumber END AS record
        FROM lineitem WHERE l_linenumber IN (2, 3)""",
    "documents_from_files": """
        SELECT lang AS doc_id, sum(length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS n_lines,
               sum(length(replace(text, chr(10), '')))::BIGINT AS n_chars
        FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL GROUP BY lang""",
}
