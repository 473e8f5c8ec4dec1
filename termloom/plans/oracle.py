"""DuckDB SQL for the queries of the catalog, written straight from the formulas.

Scores are computed densely here: every query unit against every document the query
matches, without the rearrangements the Spark side uses.
"""

from __future__ import annotations

from termloom.functions.stopwords import ENGLISH, ENGLISH_SHORT
from termloom.operators.ltr import FEATURES
from termloom.operators.prms import ENTITY_FIELDS
from termloom.plans import catalog
from termloom.plans import collection as c


def _list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def _split(text: str) -> str:
    return rf"string_split(lower(regexp_replace({text}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"


POSSESSIVE = r"regexp_replace({}, '[''’][sS]([^\p{{L}}\p{{N}}]|$)', '\1', 'g')"

ANALYZERS = {
    "index": (lambda t: t, ENGLISH),
    "standard": (lambda t: t, []),
    "english": (POSSESSIVE.format, ENGLISH_SHORT),
}


def _tokens(source: str, keys: str, text: str, analyzer: str) -> str:
    prepare, stop = ANALYZERS[analyzer]
    dropped = f"AND term NOT IN {_list(stop)}" if stop else ""
    return f"""
        SELECT {keys}, term, row_number() OVER (PARTITION BY {keys} ORDER BY i) - 1 AS pos
        FROM (SELECT {keys}, unnest(w) AS term, generate_subscripts(w, 1) AS i
              FROM (SELECT {keys}, {_split(prepare(text))} AS w FROM {source}))
        WHERE term <> '' {dropped}"""


DOCS = """
    docs AS (
        SELECT doc_id, source || ' ' || lang AS anchors,
               CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, 1, instr(text, chr(10)) - 1) ELSE '' END AS title,
               CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE text END AS body
        FROM documents)"""


def _collection(fields, analyzer="index") -> str:
    """CTEs: tok, dl, fs (field totals), qt (query tokens)."""
    parts = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {f} AS text FROM docs" for f in fields)
    return f"""
    {DOCS},
    fd AS ({parts}),
    tok AS ({_tokens('fd', 'doc_id, field', 'text', analyzer)}),
    {_totals()},
    qt AS (SELECT item_id AS query_id, term, pos
           FROM ({_tokens('benchmark', 'item_id', 'text', analyzer)}))"""


def _totals() -> str:
    return """dl AS (SELECT fd.doc_id, fd.field, count(tok.term) AS dl
           FROM (SELECT DISTINCT doc_id, field FROM fd) fd LEFT JOIN tok USING (doc_id, field) GROUP BY ALL),
    fs AS (SELECT field, count(*) AS n_docs, count(*) FILTER (dl > 0) AS doc_count,
                  sum(dl)::BIGINT AS sum_dl FROM dl GROUP BY field)"""


def _units(kinds: str, rule: str = "pairs", window: int = 3) -> str:
    """CTEs: du (document units with counts), qu (query units with counts), us (df, ttf)."""
    at = "JOIN tok b ON b.doc_id = a.doc_id AND b.field = a.field AND b.pos = a.pos"
    doc, query = [], []
    if "T" in kinds:
        doc.append("SELECT doc_id, field, 'T' AS kind, term AS unit FROM tok")
        query.append("SELECT query_id, 'T' AS kind, term AS unit FROM qt")
    nxt = "FROM qt a JOIN qt b ON a.query_id = b.query_id AND b.pos = a.pos + 1"
    if "O" in kinds:
        doc.append(f"SELECT a.doc_id, a.field, 'O' AS kind, a.term || ' ' || b.term AS unit FROM tok a {at} + 1")
        query.append(f"SELECT a.query_id, 'O' AS kind, a.term || ' ' || b.term AS unit {nxt}")
    if "U" in kinds and rule == "pairs":
        for gap in range(1, window):
            doc.append(
                "SELECT a.doc_id, a.field, 'U' AS kind, least(a.term, b.term) || ' ' || greatest(a.term, b.term) AS unit "
                f"FROM tok a {at} + {gap}"
            )
        query.append(
            "SELECT a.query_id, 'U' AS kind, least(a.term, b.term) || ' ' || greatest(a.term, b.term) AS unit " + nxt
        )
    if "U" in kinds and rule == "anchored":
        near = " UNION ALL ".join(
            f"SELECT a.doc_id, a.field, a.pos, a.term AS t1, b.term AS t2 FROM tok a {at} + ({gap})"
            for gap in range(1 - window, window)
        )
        doc.append(
            "SELECT doc_id, field, 'U' AS kind, t1 || ' ' || t2 AS unit "
            f"FROM (SELECT DISTINCT doc_id, field, pos, t1, t2 FROM ({near}))"
        )
        query.append(f"SELECT a.query_id, 'U' AS kind, a.term || ' ' || b.term AS unit {nxt}")
    return f"""
    qu AS (SELECT query_id, kind, unit, count(*) AS qf FROM ({' UNION ALL '.join(query)}) GROUP BY ALL),
    du AS (SELECT doc_id, field, kind, unit, count(*) AS tf FROM ({' UNION ALL '.join(doc)})
           WHERE (kind, unit) IN (SELECT (kind, unit) FROM qu) GROUP BY ALL),
    us AS (SELECT field, kind, unit, count(*) AS df, sum(tf)::BIGINT AS ttf FROM du GROUP BY ALL),
    cand AS (SELECT DISTINCT query_id, doc_id FROM qu JOIN du USING (kind, unit))"""


STEM = """CASE WHEN regexp_matches(term, '[^ae]ies$') THEN regexp_replace(term, 'ies$', 'y')
         WHEN regexp_matches(term, '[^aeo]es$') THEN regexp_replace(term, 's$', '')
         WHEN regexp_matches(term, '[^us]s$') AND NOT regexp_matches(term, '(ies|es)$') THEN regexp_replace(term, 's$', '')
         ELSE term END"""


def _stemmed(collection: str) -> str:
    """The collection with stems for terms in documents and queries."""
    whole = collection.replace("tok AS (", "tok0 AS (", 1).replace("qt AS (", "qt0 AS (", 1)
    whole = whole.replace("dl AS (", f"tok AS (SELECT doc_id, field, {STEM} AS term, pos FROM tok0), dl AS (", 1)
    return whole + f", qt AS (SELECT query_id, {STEM} AS term, pos FROM qt0)"


def _scored(fields, kinds="T", rule="pairs", analyzer="index", window=3) -> str:
    return "WITH" + _collection(fields, analyzer) + "," + _units(kinds, rule, window)


def _weights(weights, column="field") -> str:
    return "CASE " + column + " " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in weights.items()) + " END"


ROUND = "SELECT query_id, doc_id, round(score, 6) AS score FROM s"
ROUND_LONG = "SELECT query_id, doc_id, round(score, 4) AS score FROM s"

BM25 = """
    s AS (SELECT query_id, doc_id,
                 sum(tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (sum_dl / n_docs))) * ln(n_docs / df)) AS score
          FROM qu JOIN du USING (kind, unit) JOIN us USING (field, kind, unit)
               JOIN dl USING (doc_id, field) JOIN fs USING (field) GROUP BY ALL)"""

SEARCH = """
    s AS (SELECT query_id, doc_id, max(score) AS score FROM (
            SELECT query_id, doc_id, field,
                   sum(qf * ln(1 + (doc_count - df + 0.5) / (df + 0.5))
                       * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (sum_dl / doc_count)))) AS score
            FROM {units} JOIN du USING (kind, unit) JOIN us USING (field, kind, unit)
                 JOIN dl USING (doc_id, field) JOIN fs USING (field) {where} GROUP BY ALL)
          GROUP BY ALL)"""


def _top(k: int) -> str:
    return f"""
    top AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC)::INTEGER AS rank,
                   doc_id, score
            FROM (SELECT query_id, doc_id, round(score, 6) AS score FROM s)
            QUALIFY rank <= {k})"""


def _mixture(part: str, weight: str, where: str = "", one_query: bool = False) -> str:
    """Sum over the query's units of weight * ln(sum over fields of part), log 0 as 0."""
    return f"""
    s AS (SELECT query_id, doc_id, sum(CASE WHEN p > 0 THEN {weight} * ln(p) ELSE 0 END) AS score
          FROM (SELECT cand.query_id, cand.doc_id, qu.kind, qu.unit, qu.qf,
                       sum(CASE WHEN coalesce(us.ttf, 0) > 0 THEN {part} ELSE 0 END) AS p
                FROM cand JOIN qu USING (query_id) JOIN dl USING (doc_id) JOIN fs ON fs.field = dl.field
                     LEFT JOIN us ON us.field = dl.field AND us.kind = qu.kind AND us.unit = qu.unit
                     LEFT JOIN du ON du.doc_id = cand.doc_id AND du.field = dl.field
                                 AND du.kind = qu.kind AND du.unit = qu.unit
                     {where}
                GROUP BY ALL)
          GROUP BY ALL)"""


def _jm(weights) -> str:
    own = "CASE WHEN dl.dl > 0 THEN coalesce(du.tf, 0) / dl.dl ELSE 0 END"
    return f"{_weights(weights, 'dl.field')} * (0.9 * {own} + 0.1 * us.ttf / fs.sum_dl)"


def _dirichlet(weights) -> str:
    weight = _weights(weights, "dl.field") if weights else "1"
    return f"{weight} * (coalesce(du.tf, 0) + 100 * us.ttf / fs.sum_dl) / (dl.dl + 100)"


SDM_WEIGHT = "qf * CASE kind WHEN 'T' THEN 0.85 WHEN 'O' THEN 0.1 ELSE 0.05 END"
FSDM_FIELDS = {"title": 0.2, "body": 0.7, "anchors": 0.1}
LM_FIELDS = {"title": 0.2, "body": 0.8}

ONE_QUERY = """
    qall AS (SELECT 0::BIGINT AS query_id, kind, unit, sum(qf)::BIGINT AS qf FROM qu GROUP BY ALL),
    call AS (SELECT 0::BIGINT AS query_id, doc_id FROM docs)"""


def _for_every_document(part: str, weight: str) -> str:
    return _mixture(part, weight).replace("cand", "call").replace("qu.", "qall.").replace("JOIN qu ", "JOIN qall ")


# ---- entities --------------------------------------------------------------------------

TRIPLES = f"""
    supplied AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
    triples AS (
        SELECT '{c.RESOURCE}Part_' || p_partkey AS subject, unnest([
            {{'predicate': '{c.LABEL}', 'object': p_name, 'object_type': 'literal'}},
            {{'predicate': '{c.COMMENT_PREDICATE}', 'object': p_name || ' made by ' || p_brand || ' of size ' || p_size, 'object_type': 'literal'}},
            {{'predicate': '{c.TYPE_PREDICATE}', 'object': '{c.ONTOLOGY}Part', 'object_type': 'uri'}},
            {{'predicate': '{c.TYPE_PREDICATE}', 'object': '{c.ONTOLOGY}' || p_type, 'object_type': 'uri'}},
            {{'predicate': '{c.SUBJECT}', 'object': '{c.RESOURCE}Category:' || p_brand || '_parts', 'object_type': 'uri'}},
            {{'predicate': '{c.PROPERTY}brand', 'object': p_brand, 'object_type': 'literal'}},
            {{'predicate': '{c.PROPERTY}size', 'object': p_size::VARCHAR, 'object_type': 'literal'}}], recursive := true)
        FROM part
        UNION ALL
        SELECT '{c.RESOURCE}Part_' || l_partkey, '{c.PROPERTY}supplier', '{c.RESOURCE}Supplier_' || l_suppkey, 'uri' FROM supplied
        UNION ALL
        SELECT '{c.RESOURCE}Supplier_' || s_suppkey, unnest([
            {{'predicate': '{c.NAME}', 'object': s_name, 'object_type': 'literal'}},
            {{'predicate': '{c.TYPE_PREDICATE}', 'object': '{c.ONTOLOGY}Supplier', 'object_type': 'uri'}},
            {{'predicate': '{c.PROPERTY}nation', 'object': '{c.RESOURCE}' || n_name, 'object_type': 'uri'}}], recursive := true)
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL
        SELECT '{c.RESOURCE}Customer_' || c_custkey, unnest([
            {{'predicate': '{c.NAME}', 'object': c_name, 'object_type': 'literal'}},
            {{'predicate': '{c.TYPE_PREDICATE}', 'object': '{c.ONTOLOGY}Customer', 'object_type': 'uri'}},
            {{'predicate': '{c.SUBJECT}', 'object': '{c.RESOURCE}Category:' || c_mktsegment, 'object_type': 'uri'}},
            {{'predicate': '{c.PROPERTY}nation', 'object': '{c.RESOURCE}' || n_name, 'object_type': 'uri'}}], recursive := true)
        FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

VALUES = f"""
    vals AS (
        SELECT subject AS doc_id, predicate,
               CASE WHEN predicate IN ('{c.LABEL}', '{c.NAME}') THEN 'names'
                    WHEN predicate = '{c.COMMENT_PREDICATE}' THEN 'description'
                    WHEN predicate IN ('{c.TYPE_PREDICATE}', '{c.SUBJECT}') THEN 'types'
                    WHEN object_type = 'literal' THEN 'attributes' ELSE 'related_entities' END AS field,
               CASE WHEN object_type = 'literal' THEN object
                    ELSE regexp_replace(replace(list_extract(string_split(object, '/'), -1), '_', ' '), '^Category:', '') END AS text
        FROM triples
        WHERE subject IN (SELECT subject FROM triples
                          WHERE predicate = '{c.TYPE_PREDICATE}' AND object = '{catalog.PART}'))"""


def _entity_collection(kept: str = "") -> str:
    every = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field FROM vals" for f in ENTITY_FIELDS)
    return f"""WITH {TRIPLES}, {VALUES.replace('vals AS', 'vals0 AS')}, vals AS (SELECT * FROM vals0 {kept}),
    numbered AS (SELECT *, row_number() OVER () AS v FROM vals),
    words AS ({_tokens('numbered', 'doc_id, field, v', 'text', 'english')}),
    tok AS (SELECT doc_id, field, term, pos FROM words
            UNION ALL SELECT doc_id, 'catch_all', term, pos FROM words),
    fd AS ({every}),
    {_totals()},
    eq AS (SELECT p_name, p_name || ' ' || min(p_type) AS text FROM part GROUP BY p_name),
    qt AS (SELECT p_name AS query_id, term, pos FROM ({_tokens('eq', 'p_name', 'text', 'english')})),
    {_units('T')}"""


LM_SQL = """
    lm AS (SELECT fs.field, t.unit AS term, coalesce(us.ttf / fs.sum_dl, 0) AS p
           FROM (SELECT DISTINCT unit FROM qu) t CROSS JOIN fs
                LEFT JOIN us ON us.unit = t.unit AND us.field = fs.field),
    map AS (SELECT field, term, p / nullif(sum(p) OVER (PARTITION BY term), 0) AS p_field FROM lm)"""

PRMS = f"""
    s AS (SELECT query_id, doc_id, sum(CASE WHEN p > 0 THEN qf * ln(p) ELSE 0 END) AS score
          FROM (SELECT cand.query_id, cand.doc_id, qu.unit, qu.qf,
                       sum(coalesce(map.p_field, 0) * (coalesce(du.tf, 0) + 100 * lm.p) / (dl.dl + 100)) AS p
                FROM {{cand}} cand JOIN qu USING (query_id) JOIN dl USING (doc_id)
                     JOIN lm ON lm.term = qu.unit AND lm.field = dl.field
                     JOIN map ON map.term = qu.unit AND map.field = dl.field
                     LEFT JOIN du ON du.doc_id = cand.doc_id AND du.field = dl.field AND du.unit = qu.unit
                GROUP BY ALL)
          GROUP BY ALL)"""


# ---- judgments and learning ------------------------------------------------------------

def _sentences(table: str, key: str) -> str:
    return rf"""SELECT DISTINCT {key}, trim(x) AS sentence
        FROM (SELECT {key}, unnest(regexp_split_to_array(text, '[.\n!?]+')) AS x FROM {table})
        WHERE trim(x) <> ''"""


JUDGED = f"""
    rel AS (SELECT query_id, doc_id FROM (
              SELECT b.item_id AS query_id, d.doc_id, count(*) AS shared
              FROM ({_sentences('documents', 'doc_id')}) d JOIN ({_sentences('benchmark', 'item_id')}) b USING (sentence)
              GROUP BY ALL) LEFT JOIN labels USING (doc_id)
            WHERE quality IS NULL OR quality <> 0)"""

MEASURES = """
    hits AS (SELECT top.query_id, top.rank, row_number() OVER (PARTITION BY top.query_id ORDER BY rank) AS n
             FROM top JOIN rel USING (query_id, doc_id)),
    per_query AS (
        SELECT q.query_id,
               (SELECT count(*) FROM hits h WHERE h.query_id = q.query_id AND h.rank <= 10) / 10 AS p10,
               coalesce((SELECT sum(h.n / h.rank) FROM hits h WHERE h.query_id = q.query_id)
                        / (SELECT count(*) FROM rel r WHERE r.query_id = q.query_id), 0) AS ap,
               coalesce(1 / (SELECT min(h.rank) FROM hits h WHERE h.query_id = q.query_id), 0) AS rr
        FROM (SELECT DISTINCT query_id FROM top) q)"""

RANKED = _scored(["body"]) + "," + BM25 + "," + _top(100) + "," + JUDGED + "," + MEASURES


def _ltr() -> str:
    return _scored(["title", "body"], analyzer="english") + """,
    known AS (SELECT qu.* FROM qu JOIN us USING (kind, unit) WHERE us.field = 'body'),
    qf AS (SELECT q.query_id, coalesce(sum(k.qf), 0)::BIGINT AS query_length, sum(k.qf * ln(doc_count / df)) AS query_sum_idf,
                  max(ln(doc_count / df)) AS query_max_idf, sum(k.qf * ln(doc_count / df)) / sum(k.qf) AS query_avg_idf
           FROM (SELECT DISTINCT query_id FROM qu) q LEFT JOIN known k USING (query_id)
                LEFT JOIN us ON us.unit = k.unit AND us.field = 'body' LEFT JOIN fs ON fs.field = 'body' GROUP BY ALL),
    df AS (SELECT doc_id, sum(dl) FILTER (field = 'title')::INTEGER AS doc_length_title,
                  sum(dl) FILTER (field = 'body')::INTEGER AS doc_length_body FROM dl GROUP BY ALL)"""


def _pair_features() -> str:
    columns = ", ".join(
        f"""count(tf) FILTER (field = '{f}') AS unique_query_terms_in_{f},
            coalesce(sum(k.qf * tf) FILTER (field = '{f}'), 0)::BIGINT AS sum_TF_{f},
            coalesce(max(tf) FILTER (field = '{f}'), 0) AS max_TF_{f},
            coalesce(sum(k.qf * tf) FILTER (field = '{f}') / any_value(q.query_length), 0) AS avg_TF_{f}"""
        for f in ("title", "body")
    )
    return f"""
    pf AS (SELECT pairs.query_id, pairs.doc_id, {columns}
           FROM pairs JOIN qf q USING (query_id) LEFT JOIN known k USING (query_id)
                LEFT JOIN du ON du.doc_id = pairs.doc_id AND du.unit = k.unit GROUP BY ALL)"""


def _features(names) -> str:
    real = {"query_sum_idf", "query_max_idf", "query_avg_idf", "avg_TF_title", "avg_TF_body"}
    return ", ".join(f"round({n}, 6) AS {n}" if n in real else n for n in names)


FIRST_PASS = SEARCH.format(units="known", where="") + "," + _top(100)
ID_BUCKET = "('0x' || substr(md5({}::VARCHAR), 1, 8))::BIGINT % 100"


def oracle_sql() -> dict[str, str]:
    tb = ["title", "body"]
    postings = "post AS (SELECT field, term, doc_id, count(*) AS tf FROM tok GROUP BY ALL)"
    two = "WITH" + _collection(tb) + "," + postings
    plain = r"regexp_split_to_array(text, '[\s.,:;?!]+')"
    words = f"SELECT doc_id, unnest({plain}) AS term FROM documents"
    stripped = "regexp_replace(text, '[.,:;?!]+', '', 'g')"
    vector = " || ',' || ".join(f"count(*) FILTER (term = '{t}')" for t in catalog.VOCABULARY)
    ranked_columns = "query_id, rank, doc_id, score"
    sql = {
        "unique_elements": f"""
            SELECT user_id::VARCHAR AS elem, count(*) AS occurrences, min(event_id) AS first_pos
            FROM events GROUP BY user_id HAVING count(*) >= {catalog.MIN_REPEATS}""",
        "word_freq": f"SELECT doc_id, term, count(*) AS tf FROM ({words}) WHERE term <> '' GROUP BY ALL",
        "feature_vector": f"""
            SELECT doc_id, {vector} AS vector
            FROM (SELECT doc_id, unnest(list_append({plain}, '')) AS term FROM documents) GROUP BY doc_id""",
        "strip_punct": rf"""
            WITH w AS (
                SELECT doc_id, string_agg(term, ' ' ORDER BY i) AS clean_no_stop
                FROM (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS i
                      FROM (SELECT doc_id, regexp_split_to_array({stripped}, '\s+') AS w FROM documents))
                WHERE term <> '' AND lower(term) NOT IN {_list(ENGLISH)} GROUP BY doc_id)
            SELECT doc_id, {stripped} AS clean, coalesce(clean_no_stop, '') AS clean_no_stop
            FROM documents LEFT JOIN w USING (doc_id)""",
        "tokens": f"WITH {_collection(tb)} SELECT doc_id, field, pos::INTEGER AS pos, term FROM tok",
        "english_tokens": f"WITH {_collection(tb, 'english')} SELECT doc_id, field, pos::INTEGER AS pos, term FROM tok",
        "query_terms": f"""
            WITH {_collection(['body'], 'standard')}
            SELECT query_id, pos::INTEGER AS qpos, term FROM qt WHERE term IN (SELECT term FROM tok)""",
        "index_postings": f"""{two} SELECT field, term, doc_id, tf, dl::INTEGER AS dl
            FROM post JOIN dl USING (doc_id, field)""",
        "index_terms": f"{two} SELECT DISTINCT term FROM post WHERE field = 'title'",
        "postings_lookup": f"""{two} SELECT doc_id, tf FROM post
            WHERE field = '{catalog.LOOKUP[0]}' AND term = '{catalog.LOOKUP[1]}'""",
        "doc_vectors": f"{two} SELECT doc_id, term, tf FROM post WHERE field = 'title'",
        "term_stats": f"""{two} SELECT field, term, count(*) AS df, sum(tf)::BIGINT AS ttf,
            round(ln(any_value(n_docs) / count(*)), 6) AS idf FROM post JOIN fs USING (field) GROUP BY field, term""",
        "field_lengths": f"""WITH {_collection(c.FIELDS)}
            SELECT field, n_docs, doc_count, sum_dl AS total_len, round(sum_dl / n_docs, 6) AS avg_len FROM fs""",
        "simple": f"""{_scored(['body'])},
            s AS (SELECT query_id, doc_id, sum(tf * qf)::DOUBLE AS score FROM qu JOIN du USING (kind, unit) GROUP BY ALL)
            {ROUND}""",
        "bm25": f"{_scored(['body'])}, {BM25} {ROUND}",
        "bm25_stored_top": f"{_scored(['body'])}, {BM25}, {_top(10)} SELECT {ranked_columns} FROM top",
        "bm25_top": f"{_scored(['body'])}, {BM25}, {_top(10)} SELECT {ranked_columns} FROM top",
        "lm_jm": f"{_scored(['body'])}, {_mixture(_jm({'body': 1.0}), 'qf')} {ROUND}",
        "best_document": f"""{_scored(['body'])}, {_mixture(_jm({'body': 1.0}), 'qf')}, {_top(1)}
            SELECT {ranked_columns} FROM top""",
        "mlm": f"{_scored(tb)}, {_mixture(_jm(LM_FIELDS), 'qf')} {ROUND}",
        "bm25f": f"""{_scored(tb)},
            s AS (SELECT query_id, doc_id,
                         sum(c / (1.2 + c) * coalesce(ln((SELECT any_value(n_docs) FROM fs) / us.df), 0)) AS score
                  FROM (SELECT query_id, doc_id, kind, unit,
                               sum({_weights(LM_FIELDS)} * tf / (0.25 + 0.75 * dl / (sum_dl / n_docs))) AS c
                        FROM qu JOIN du USING (kind, unit) JOIN dl USING (doc_id, field) JOIN fs USING (field)
                        GROUP BY ALL) x
                       LEFT JOIN us ON us.field = 'body' AND us.kind = x.kind AND us.unit = x.unit
                  GROUP BY ALL)
            {ROUND}""",
        "lm_every_document": f"""{_scored(['body'])}, {ONE_QUERY},
            {_for_every_document(_jm({'body': 1.0}), 'qf')} {ROUND_LONG}""",
        "sdm_every_document": f"""{_scored(['body'], 'TOU')}, {ONE_QUERY},
            {_for_every_document(_dirichlet({}), SDM_WEIGHT)} {ROUND_LONG}""",
        "sdm_total": f"{_scored(['body'], 'TOU')}, {_mixture(_dirichlet({}), SDM_WEIGHT)} {ROUND}",
        "sdm_anchored": f"{_scored(['body'], 'U', 'anchored')}, {_mixture(_dirichlet({}), 'qf')} {ROUND}",
        "fsdm_total": f"{_scored(c.FIELDS, 'TOU')}, {_mixture(_dirichlet(FSDM_FIELDS), SDM_WEIGHT)} {ROUND}",
        "entity_dict": f"""
            WITH {TRIPLES}
            SELECT subject, predicate, row_number() OVER (PARTITION BY subject, predicate ORDER BY object) AS pos, object,
                   count(*) OVER (PARTITION BY subject, predicate) = 1 AS is_single
            FROM triples""",
        "entity_fields": f"""
            WITH {TRIPLES}, {VALUES}
            SELECT doc_id AS entity_id, field, row_number() OVER (PARTITION BY doc_id, field ORDER BY predicate, text) AS pos, text AS value
            FROM (SELECT doc_id, field, predicate, text FROM vals UNION ALL SELECT doc_id, 'catch_all', predicate, text FROM vals)""",
        "entity_candidates": f"""
            WITH links AS (
                SELECT '/' || regexp_extract(html, '<title>([^ <]*)', 1) AS page,
                       unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
            SELECT DISTINCT link AS entity FROM links
            WHERE page IN (SELECT link FROM links WHERE starts_with(link, '{catalog.LINK_PREFIX}'))
            """,
        "baseline_topk": f"""{_entity_collection()}, {SEARCH.format(units='qu', where="WHERE field = 'catch_all'")},
            {_top(100)} SELECT {ranked_columns} FROM top""",
        "collection_lm": f"{_entity_collection()}, {LM_SQL} SELECT field, term, round(p, 6) AS p FROM lm",
        "term_mapping": f"{_entity_collection()}, {LM_SQL} SELECT field, term, round(p_field, 6) AS p_field FROM map",
        "prms": f"{_entity_collection()}, {LM_SQL}, {PRMS.format(cand='cand')} {ROUND}",
        "prms_topk": f"""{_entity_collection()}, {LM_SQL},
            {SEARCH.format(units='qu', where="WHERE field = 'catch_all'").replace('s AS (', 's0 AS (', 1)},
            {_top(200).replace('FROM s)', 'FROM s0)').replace('top AS', 'first AS')},
            {PRMS.format(cand='first')}, {_top(200)} SELECT {ranked_columns} FROM top""",
        "item_occurrences": f"SELECT count(*) AS occurrences FROM events WHERE user_id::VARCHAR = '{catalog.ITEM}'",
        "term_frequency": f"""{two} SELECT coalesce(sum(tf), 0)::BIGINT AS tf FROM post
            WHERE field = '{catalog.LOOKUP[0]}' AND term = '{catalog.LOOKUP[1]}' AND doc_id = {catalog.LOOKUP_DOC}""",
        "field_documents": f"{two} SELECT doc_id, dl::INTEGER AS n_terms FROM dl WHERE field = 'title' AND dl > 0",
        "entity_keys": "SELECT p_partkey, replace(replace(p_name || ' & ' || p_brand, ' ', '_'), '&', 'and') AS key FROM part",
        "evaluate": """
            WITH m AS (SELECT count(*) FILTER (quality = 0 AND toxic = 1) AS tn, count(*) FILTER (quality = 0 AND toxic = 0) AS fp,
                              count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 1 AND toxic = 0) AS tp
                       FROM labels)
            SELECT round(tp / nullif(tp + fn, 0), 6) AS recall, round(tp / nullif(tp + fp, 0), 6) AS precision,
                   round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1,
                   round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy FROM m""",
        "confusion": """
            SELECT count(*) FILTER (quality = 1 - toxic AND toxic <> 0) AS tn,
                   count(*) FILTER (quality <> 1 - toxic AND toxic = 0) AS fp,
                   count(*) FILTER (quality <> 1 - toxic AND toxic <> 0) AS fn,
                   count(*) FILTER (quality = 1 - toxic AND toxic = 0) AS tp
            FROM labels""",
        "binary_metrics": """
            WITH m AS (SELECT count(*) FILTER (quality = 0 AND toxic = 1) AS tn, count(*) FILTER (quality = 0 AND toxic = 0) AS fp,
                              count(*) FILTER (quality = 1 AND toxic = 1) AS fn, count(*) FILTER (quality = 1 AND toxic = 0) AS tp
                       FROM labels)
            SELECT round((tp + tn) / nullif(tp + tn + fp + fn, 0), 6) AS accuracy,
                   round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
                   round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1,
                   round(fp / nullif(fp + tn, 0), 6) AS false_positive_rate,
                   round(fn / nullif(fn + tp, 0), 6) AS false_negative_rate
            FROM m""",
        "qrels_relevant": f"WITH {JUDGED} SELECT query_id, doc_id FROM rel",
        "precision_at_k": f"{RANKED} SELECT query_id, round(p10, 6) AS value FROM per_query",
        "average_precision": f"{RANKED} SELECT query_id, round(ap, 6) AS value FROM per_query",
        "reciprocal_rank": f"{RANKED} SELECT query_id, round(rr, 6) AS value FROM per_query",
        "mean_measure": f"{RANKED} SELECT round(avg(rr), 6) AS mean FROM per_query",
        "first_pass": f"{_ltr()}, {FIRST_PASS} SELECT {ranked_columns} FROM top",
        "ltr_query_feats": f"{_ltr()} SELECT query_id, {_features(FEATURES[:4])} FROM qf",
        "ltr_doc_feats": f"{_ltr()} SELECT doc_id, doc_length_title, doc_length_body FROM df",
        "ltr_pair_feats": f"""{_ltr()}, {JUDGED}, pairs AS (SELECT * FROM rel), {_pair_features()}
            SELECT query_id, doc_id, {_features(FEATURES[6:])} FROM pf""",
        "ltr_matrix": f"""{_ltr()}, {FIRST_PASS}, pairs AS (SELECT query_id, doc_id FROM top), {_pair_features()}
            SELECT query_id, doc_id, {_features(FEATURES)} FROM pf JOIN qf USING (query_id) JOIN df USING (doc_id)""",
        "ltr_training": f"""{_ltr()}, {FIRST_PASS}, {JUDGED},
            pairs AS (SELECT query_id, doc_id FROM top UNION SELECT query_id, doc_id FROM rel), {_pair_features()}
            SELECT query_id, doc_id, ((query_id, doc_id) IN (SELECT (query_id, doc_id) FROM rel))::INTEGER AS label,
                   {_features(FEATURES)} FROM pf JOIN qf USING (query_id) JOIN df USING (doc_id)""",
        "id_split": f"""SELECT item_id AS query_id, ({ID_BUCKET.format('item_id')})::INTEGER AS bucket,
            {ID_BUCKET.format('item_id')} < 80 AS is_train FROM benchmark""",
        "tfidf": rf"""
            WITH w AS (SELECT doc_id, {ID_BUCKET.format('doc_id')} < 80 AS is_train,
                              unnest(regexp_extract_all(lower({stripped}), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term FROM documents),
            tf AS (SELECT doc_id, is_train, term, count(*) AS tf FROM w GROUP BY ALL),
            df AS (SELECT term, count(*) AS df FROM tf WHERE is_train GROUP BY term),
            n AS (SELECT count(*) AS n FROM documents WHERE {ID_BUCKET.format('doc_id')} < 80),
            raw AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (term), n)
            SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
    }
    for name, scores in (("simple", "simple"), ("lm", "lm_jm"), ("bm25f", "bm25f"), ("mlm", "mlm")):
        sql[f"{name}_top"] = f"""
            SELECT query_id, rank, doc_id, score FROM (
                SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC)::INTEGER AS rank FROM ({sql[scores]}))
            WHERE rank <= 10"""
    held_out = ID_BUCKET.format("query_id") + " >= 80"
    sql["first_pass_mrr"] = f"""{_ltr()}, {FIRST_PASS}, {JUDGED}, {MEASURES}
        SELECT round(avg(rr), 6) AS mean FROM per_query WHERE {held_out}"""
    sql["ltr_reranked"] = f"""{_ltr()}, {FIRST_PASS}
        SELECT query_id, count(*) AS documents, count(*)::INTEGER AS last_rank FROM top WHERE {held_out} GROUP BY query_id"""
    without = rf"""array_to_string(list_filter(regexp_split_to_array({stripped}, '\s+'),
        lambda w: w <> '' AND lower(w) NOT IN {_list(ENGLISH)}), ' ')"""
    cells = sql["tfidf"].replace(stripped, without).replace("FROM documents),\n            tf AS", "FROM documents SEMI JOIN labels USING (doc_id)),\n            tf AS")
    cells = cells.replace("FROM documents WHERE", "FROM documents SEMI JOIN labels USING (doc_id) WHERE").replace("round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6)", "raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id))")
    sql["spam_cells"] = f"""
        SELECT doc_id, 1 - quality AS label, {ID_BUCKET.format('doc_id')} < 80 AS is_train, count(term) AS cells, round(coalesce(sum(weight), 0), 6) AS total
        FROM documents JOIN labels USING (doc_id) LEFT JOIN ({cells}) USING (doc_id) GROUP BY ALL"""
    listed = f"""WHERE doc_id IN (
        SELECT '{c.RESOURCE}Part_' || p_partkey FROM part
        WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size = (SELECT max(p_size) FROM part)))"""
    sql["candidate_index"] = f"""{_entity_collection(listed)}
        SELECT field, unit AS term, doc_id, tf, dl FROM du JOIN dl USING (doc_id, field)"""
    sql["bm25_grown_top"] = sql["bm25_top"]
    sql["stemmed_postings"] = f"""WITH {_stemmed(_collection(tb))}, {postings} SELECT field, term, doc_id, tf, dl::INTEGER AS dl
        FROM post JOIN dl USING (doc_id, field)"""
    sql["stemmed_bm25"] = f"WITH {_stemmed(_collection(['body']))}, {_units('T')}, {BM25} {ROUND}"
    sql["sdm_stored"] = " UNION ALL ".join(
        f"""SELECT {window} AS near, '{rule}' AS rule, * FROM ({_scored(['body'], 'TOU', rule, window=window)}, {_mixture(_dirichlet({}), SDM_WEIGHT)},
            {_top(10)} SELECT {ranked_columns} FROM top)"""
        for window, rule in catalog.STORED_RULES
    )
    # every document that is in the collection, matching or not, for every query with a known unit
    every = ("cand AS (SELECT DISTINCT query_id, doc_id FROM qu JOIN du USING (kind, unit))",
             "cand AS (SELECT query_id, doc_id FROM (SELECT DISTINCT query_id FROM qu JOIN du USING (kind, unit)) CROSS JOIN docs)")
    everything = every[1].replace("CROSS JOIN docs", "CROSS JOIN (SELECT DISTINCT doc_id FROM vals)")
    sql["prms_top"] = f"{_entity_collection()}, {LM_SQL}, {PRMS.format(cand='cand')}, {_top(10)} SELECT {ranked_columns} FROM top".replace(every[0], everything)
    for name, fields, part in (("sdm_top", ["body"], _dirichlet({})), ("fsdm_top", c.FIELDS, _dirichlet(FSDM_FIELDS))):
        sql[name] = f"{_scored(fields, 'TOU')}, {_mixture(part, SDM_WEIGHT)}, {_top(10)} SELECT {ranked_columns} FROM top".replace(*every)
    for name, kind in catalog.KIND.items():
        sql[f"sdm_{name}"] = f"{_scored(['body'], kind)}, {_mixture(_dirichlet({}), 'qf')} {ROUND}"
        sql[f"fsdm_{name}"] = f"{_scored(c.FIELDS, kind)}, {_mixture(_dirichlet(FSDM_FIELDS), 'qf')} {ROUND}"
    return sql
