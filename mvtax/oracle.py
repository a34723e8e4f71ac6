"""DuckDB SQL twins of :mod:`mvtax.catalog` (independent re-statements, used as the oracle).

Tables are the driver's views (``embeddings``, ``documents``, ...). Written directly from
the operator definitions, not from the Spark plans.
"""

from __future__ import annotations

from .sources.tables import SEGMENT_ROLES, TYPE_MODELS, VIEW_SLICES
from .config import PCA_DIMS, VIEW_WEIGHTS


_NV = [0]
_WB = r"\b"  # regex word boundary


def _let(expr: str, body) -> str:
    """Bind ``expr`` once: ``body(name)`` may use ``name`` many times (keeps the SQL linear)."""
    _NV[0] += 1
    v = f"v{_NV[0]}"
    return f"list_transform([{expr}], lambda {v}: {body(v)})[1]"


def r4(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE), 4) + 0.0)"


def _norm(x: str) -> str:
    def body(v):
        nrm = f"sqrt(list_sum(list_transform({v}, lambda t: t * t)))"
        return (f"CASE WHEN {nrm} > 0 THEN list_transform({v}, lambda t: t / {nrm}) "
                f"ELSE list_transform({v}, lambda t: t * 0.0) END")
    return _let(x, body)


FULL_VIEW = f"""vecs AS (SELECT vec_id AS id, 'all' AS view, {_norm('CAST(embedding AS DOUBLE[])')} AS x
                 FROM embeddings)"""


def _slices_view() -> str:
    parts = []
    for v, (s, ln) in VIEW_SLICES.items():
        parts.append(f"SELECT vec_id AS id, '{v}' AS view, "
                     f"{_norm(f'CAST(embedding AS DOUBLE[])[{s + 1}:{s + ln}]')} AS x FROM embeddings")
    return "vecs AS (" + " UNION ALL ".join(parts) + ")"


def _knn(kmax_expr: str) -> str:
    return f"""pairs AS (SELECT a.view, a.id AS src, b.id AS dst, 1.0 - list_inner_product(a.x, b.x) AS dist
                  FROM vecs a JOIN vecs b ON a.view = b.view AND a.id <> b.id),
nbr AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY view, src ORDER BY dist, dst) AS rank
                       FROM pairs) WHERE rank <= {kmax_expr})"""


def _ks_list(ks) -> str:
    return "ks AS (SELECT unnest([" + ", ".join(str(k) for k in ks) + "]) AS k)"


def _ks_adaptive(base) -> str:
    b = ", ".join(str(x) for x in base)
    return f"""cnt AS (SELECT count(*) AS n FROM embeddings),
ks AS (SELECT DISTINCT greatest(1, least(least(k0, greatest(2, n - 1)), n - 1)) AS k
       FROM (SELECT n, greatest(2, CAST(round_even(b * greatest(0.7, least(1.6, sqrt(greatest(n, 1)) / 25.0)), 0)
                                       AS INTEGER)) AS k0
             FROM cnt, (SELECT unnest([{b}]) AS b)))"""


GRAPH_CHAIN = """e AS (SELECT nbr.view, ks.k, nbr.src, nbr.dst, nbr.dist, nbr.rank FROM nbr JOIN ks ON nbr.rank <= ks.k),
sig AS (SELECT view, k, src AS id, dist + 1e-12 AS sigma FROM e WHERE rank = least(7, k)),
heat AS (SELECT e.view, e.k, e.src, e.dst, exp(-(e.dist * e.dist) / (si.sigma * sj.sigma)) AS w
         FROM e JOIN sig si ON si.view = e.view AND si.k = e.k AND si.id = e.src
                JOIN sig sj ON sj.view = e.view AND sj.k = e.k AND sj.id = e.dst),
mutual AS (SELECT h1.view, h1.k, h1.src, h1.dst, least(h1.w, h2.w) AS w
           FROM heat h1 JOIN heat h2 ON h1.view = h2.view AND h1.k = h2.k AND h1.src = h2.dst AND h1.dst = h2.src),
nb AS (SELECT view, k, src, list(dst) AS nbrs FROM e GROUP BY view, k, src),
snn0 AS (SELECT e.view, e.k, e.src, e.dst, CAST(len(list_intersect(ni.nbrs, nj.nbrs)) AS DOUBLE) / e.k AS w
         FROM e JOIN nb ni ON ni.view = e.view AND ni.k = e.k AND ni.src = e.src
                JOIN nb nj ON nj.view = e.view AND nj.k = e.k AND nj.src = e.dst),
snn AS (SELECT view, k, src, dst, max(w) AS w FROM (
          SELECT view, k, src, dst, w FROM snn0 WHERE w > 0
          UNION ALL SELECT view, k, dst AS src, src AS dst, w FROM snn0 WHERE w > 0) GROUP BY view, k, src, dst),
blend AS (SELECT view, k, src, dst, sum(w) AS w FROM (
          SELECT view, k, src, dst, 0.65 * w AS w FROM mutual
          UNION ALL SELECT view, k, src, dst, 0.35 * w AS w FROM snn) GROUP BY view, k, src, dst),
deg AS (SELECT view, k, src AS id, sum(w) AS deg FROM blend GROUP BY view, k, src),
norm AS (SELECT b.view, b.k, b.src, b.dst,
                b.w / sqrt(greatest(di.deg, 1e-12)) / sqrt(greatest(dj.deg, 1e-12)) AS w
         FROM blend b JOIN deg di ON di.view = b.view AND di.k = b.k AND di.id = b.src
                      JOIN deg dj ON dj.view = b.view AND dj.k = b.k AND dj.id = b.dst),
ms AS (SELECT view, src, dst, sum(w) / (SELECT count(*) FROM ks) AS w FROM norm GROUP BY view, src, dst)"""


def _weights() -> str:
    rows = " UNION ALL ".join(f"SELECT '{v}' AS view, {w} AS wv" for v, w in VIEW_WEIGHTS.items())
    return f"wts AS ({rows})"


def _graph(final: str, ks: str, kmax: str, view: str = FULL_VIEW) -> str:
    return f"WITH {view},\n{ks},\n{_knn(kmax)},\n{GRAPH_CHAIN}\n{final}"


def _edges(t: str) -> str:
    return f"SELECT src, dst, {r4('w')} AS w FROM {t}"


def _adaptive_kset_sql() -> str:
    parts = []
    for lvl, base in (("Broad", (6, 8, 10)), ("Sub", (8, 12, 18)), ("Niche", (6, 10, 14))):
        b = ", ".join(str(x) for x in base)
        parts.append(f"""SELECT label, '{lvl}' AS level, n,
       array_to_string(list_sort(list_distinct(list_transform(k1, lambda k: greatest(1, least(k, n - 1))))), ',') AS kset
FROM (SELECT label, n, list_transform(list_sort(list_distinct(list_transform([{b}],
        lambda b: greatest(2, CAST(round_even(b * greatest(0.7, least(1.6, sqrt(greatest(n, 1)) / 25.0)), 0) AS INTEGER))))),
        lambda k: least(k, greatest(2, n - 1))) AS k1
      FROM (SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM embeddings GROUP BY label))""")
    return "\nUNION ALL\n".join(parts)


SINGLE = _ks_list((10,))

ORACLE = {
    "l2_normalize": f"""WITH {FULL_VIEW}
SELECT id, CAST(p - 1 AS BIGINT) AS pos, {r4('x[p]')} AS x FROM vecs, range(1, len(x) + 1) t(p)""",
    "knn": f"""WITH {FULL_VIEW},
{_knn(10)}
SELECT src, dst, CAST(rank AS BIGINT) AS rank, {r4('dist')} AS dist FROM nbr""",
    "local_scale": _graph(f"SELECT id, {r4('sigma')} AS sigma FROM sig", SINGLE, 10),
    "heat_affinity": _graph(_edges("heat"), SINGLE, 10),
    "mutual_knn": _graph(_edges("mutual"), SINGLE, 10),
    "snn_graph": _graph(_edges("snn"), SINGLE, 10),
    "affinity_blend": _graph(_edges("blend"), SINGLE, 10),
    "degree": _graph(f"SELECT id, {r4('deg')} AS deg FROM deg", SINGLE, 10),
    "laplacian": _graph(f"""SELECT src, dst, {r4('-w')} AS l FROM norm
UNION ALL SELECT vec_id AS src, vec_id AS dst, 1.0 AS l FROM embeddings""", SINGLE, 10),
    "multi_scale": _graph(_edges("ms"), _ks_list((5, 7, 9)), 9),
    "view_fusion": _graph(f"""{_weights().replace('wts AS', ', wts AS', 1)}
SELECT src, dst, {r4('sum(wv * w)')} AS w FROM ms JOIN wts USING (view) GROUP BY src, dst""".lstrip(),
                          _ks_adaptive((6, 8, 10)), "(SELECT max(k) FROM ks)", _slices_view()),
    "adaptive_kset": _adaptive_kset_sql(),
}


# ---------------------------------------------------------------- text layer

WSC = r"[\t\n\x0B\f\r ]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WSC}+|{WSC}+$', '', 'g')"


def _case(col: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


RECORDS = f"""records AS (
  SELECT d.doc_id AS id,
         coalesce(c.c_name, '') AS company_name,
         coalesce(g.url, '') AS website_url,
         coalesce(d.text, '') AS ai_summary,
         coalesce(c.c_mktsegment, '') AS industry,
         concat_ws('; ', p.p_name, p.p_brand) AS services,
         coalesce(d.lang, '') AS market_focus,
         coalesce({_case('c.c_mktsegment', SEGMENT_ROLES)}, '') AS roles,
         '' AS customer_types,
         coalesce(p.p_type, '') AS product_categories,
         coalesce(c.c_mktsegment, '') AS customers_segments,
         coalesce({_case('p.p_type', TYPE_MODELS)}, '') AS business_model,
         coalesce(d.source, '') AS certifications,
         coalesce(CASE WHEN p.p_name IS NOT NULL THEN '[''' || p.p_name || ''', ''' || lower(p.p_type) || ''']' END, '')
           AS keywords,
         coalesce(n.n_name, '') AS location
  FROM documents d
  LEFT JOIN customer c ON c.c_custkey = d.doc_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN part p ON p.p_partkey = d.doc_id
  LEFT JOIN pages g ON g.page_id = d.doc_id)"""


def _to_list(x: str) -> str:
    """List literal of quoted strings, else split on ``; , | tab``; items trimmed, blanks dropped."""
    def body(s):
        quoted = f"regexp_extract_all({s}, '''([^'']*)''', 1)"
        split = f"string_split_regex({s}, '[;,|]|\\t')"
        return (f"(CASE WHEN {s} = '' THEN []::VARCHAR[] "
                f"WHEN {s} LIKE '[%]' THEN list_filter(list_transform({quoted}, lambda t: {_strip('t')}), lambda t: t <> '') "
                f"ELSE list_filter(list_transform({split}, lambda t: {_strip('t')}), lambda t: t <> '') END)")
    return _let(_strip(x), body)


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in __import__('mvtax.config', fromlist=['x']).STOPWORDS) + "]"
BAN_SQL = "[" + ", ".join(f"'{w}'" for w in __import__('mvtax.config', fromlist=['x']).GENERIC_BAN) + "]"
ACR_SQL = "[" + ", ".join(f"'{w}'" for w in __import__('mvtax.config', fromlist=['x']).ACRONYMS) + "]"


def _tokens(x: str) -> str:
    s = f"regexp_replace(lower({x}), '[^a-z0-9 \\-/&]', ' ', 'g')"
    return f"list_filter(string_split_regex({s}, ' +'), lambda t: t <> '' AND NOT list_contains({STOP_SQL}, t))"


def _ngrams(t: str, n: int) -> str:
    return (f"(CASE WHEN len({t}) >= {n} THEN list_transform(range(1, len({t}) - {n} + 2), "
            f"lambda i: array_to_string({t}[i:i + {n - 1}], ' ')) ELSE []::VARCHAR[] END)")


def _no_ban(grams: str) -> str:
    return f"list_filter({grams}, lambda g: NOT list_has_any(string_split(g, ' '), {BAN_SQL}))"


def _title(x: str) -> str:
    """M3 title case keeping acronyms."""
    s = _strip(x)
    pieces = f"regexp_extract_all({s}, '({WSC}+|&|/|-|[^\\t\\n\\x0B\\f\\r &/-]+)', 1)"
    t = (f"list_transform({pieces}, lambda w: CASE WHEN regexp_full_match(w, '{WSC}+|&|/|-') THEN w "
         f"WHEN list_contains({ACR_SQL}, upper(w)) THEN upper(w) "
         f"ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END)")
    return _strip(f"array_to_string({t}, '')")


def _pytitle(x: str) -> str:
    def body(chars):
        return (f"array_to_string(list_transform({chars}, lambda ch, i: CASE WHEN i = 1 OR NOT regexp_full_match("
                f"{chars}[i - 1], '[A-Za-z]') THEN upper(ch) ELSE lower(ch) END), '')")
    return _let(f"string_split({x}, '')", body)


def _collapse_dups(x: str) -> str:
    """Drop a word run equal (case-insensitively) to the run two pieces back when only spaces
    separate them - the repeated-word rule without back-references."""
    def body(pc):
        keep = (f"list_filter({pc}, lambda p, i: NOT ("
                f"(regexp_full_match(p, '\\w+') AND i >= 3 AND regexp_full_match({pc}[i - 1], '\\s+') "
                f"AND lower({pc}[i - 2]) = lower(p)) OR "
                f"(regexp_full_match(p, '\\s+') AND i >= 2 AND i < len({pc}) "
                f"AND regexp_full_match({pc}[i + 1], '\\w+') AND lower({pc}[i - 1]) = lower({pc}[i + 1]))))")
        return f"array_to_string({keep}, '')"
    return _let(f"regexp_extract_all({x}, '(\\w+|\\W+)', 1)", body)


def _sanitize(x: str) -> str:
    s = f"regexp_replace({_strip(x)}, '[^A-Za-z0-9\\-&() /]+', '', 'g')"
    s = f"trim(regexp_replace({s}, ' +', ' ', 'g'))"
    s = _collapse_dups(s)
    ban = "|".join(__import__('mvtax.config', fromlist=['x']).GENERIC_BAN)
    s = f"trim(regexp_replace({s}, '(?i)\\b({ban})\\b', '', 'g'))"
    s = f"regexp_replace({s}, ' {{2,}}', ' ', 'g')"
    return f"regexp_replace({s}, '^-+ *| *-+$', '', 'g')"


def _view_text_sql() -> str:
    url = "regexp_replace(website_url, 'https?://', '', 'g')"
    return f"""WITH {RECORDS}
SELECT id,
  ai_summary || ' || Services: ' || services AS v1,
  'Roles: ' || roles || ' || Business Model: ' || business_model || ' || Product Categories: ' || product_categories
    || ' || Keywords: ' || keywords AS v2,
  'Market Focus: ' || market_focus || ' || Customer Segments: ' || customers_segments || ' || Certifications: '
    || certifications AS v3,
  'Company: ' || company_name || ' || Industry: ' || industry || ' || Domain: ' || {url} AS v4,
  'Company: ' || company_name || ' | Industry: ' || industry || ' | Roles: ' || roles || ' | Services: ' || services
    || ' | Market Focus: ' || market_focus || ' | Customer Segments: ' || customers_segments || ' | Business Model: '
    || business_model || ' | Keywords: ' || keywords || ' | Summary: ' || ai_summary AS v5,
  location AS vloc
FROM records"""


def _gram_head_sql(src: str, key: str, blob: str) -> str:
    """W9 per key over tokens(blob): count desc, 3-grams first, first position; title of words."""
    return f"""tk AS (SELECT {key} AS k, {_tokens(blob)} AS t FROM {src}),
gr AS (SELECT k, g.gram, 3 AS n, g.pos FROM tk, unnest(list_transform({_ngrams('t', 3)}, lambda x, i: {{'gram': x, 'pos': i}})) AS u(g)
       UNION ALL
       SELECT k, g.gram, 2 AS n, g.pos FROM tk, unnest(list_transform({_ngrams('t', 2)}, lambda x, i: {{'gram': x, 'pos': i}})) AS u(g)),
grc AS (SELECT k, gram, n, count(*) AS cnt, min(pos) AS first FROM gr
        WHERE NOT list_has_any(string_split(gram, ' '), {BAN_SQL}) GROUP BY k, gram, n),
gbest AS (SELECT k, array_to_string(list_transform(string_split(gram, ' ')[1:3], lambda w: {_pytitle('w')}), ' ')
                 AS gram_head
          FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY cnt DESC, n DESC, first) AS r FROM grc) WHERE r = 1)"""


TEXT_ORACLE = {
    "select_known_columns": f"WITH {RECORDS} SELECT * FROM records",
    "view_text": _view_text_sql(),
    "strip_scheme": "SELECT page_id, url, regexp_replace(url, 'https?://', '', 'g') AS domain FROM pages",
    "to_list": f"""WITH {RECORDS}
SELECT id, {', '.join(f"array_to_string({_to_list(c)}, '|') AS {c}_items, CAST(len({_to_list(c)}) AS BIGINT) AS {c}_n"
                      for c in ('keywords', 'services', 'roles', 'business_model'))}
FROM records""",
    "uniq_list": f"""WITH {RECORDS},
u AS (SELECT id, list_concat({_to_list('services')}, {_to_list('keywords')}, {_to_list('roles')},
                             string_split(product_categories, ' ')) AS l FROM records),
x AS (SELECT id, list_filter(list_transform(l, lambda t: {_strip('t')}), lambda t: t <> '') AS l FROM u),
d AS (SELECT id, list_filter(l, lambda t, i: list_position(l, t) = i) AS l FROM x)
SELECT id, array_to_string(l, '|') AS items, CAST(len(l) AS BIGINT) AS n FROM d""",
    "tokens": f"""WITH {RECORDS}
SELECT id, CAST(len({_tokens('ai_summary')}) AS BIGINT) AS n_tokens, array_to_string({_tokens('ai_summary')}, ' ') AS tokens
FROM records""",
    "ngrams": f"""WITH {RECORDS},
{_gram_head_sql('records', 'id', 'lower(ai_summary)')},
c AS (SELECT k, CAST(len({_ngrams('t', 2)}) AS BIGINT) AS n2, CAST(len({_ngrams('t', 3)}) AS BIGINT) AS n3,
             CAST(len({_no_ban(f"list_concat({_ngrams('t', 2)}, {_ngrams('t', 3)})")}) AS BIGINT) AS n_kept FROM tk)
SELECT c.k AS id, n2, n3, n_kept, coalesce(gram_head, '') AS top_gram FROM c LEFT JOIN gbest USING (k)""",
    "title_case": f"""SELECT p_partkey, {_title("' ' || p_name || '/' || lower(p_type) || ' hvac-plc & ' || p_brand || chr(9) || 'scada '")} AS title
FROM part""",
    "sanitize_label": f"""SELECT p_partkey, {_sanitize("'- ' || p_name || ' ' || upper(p_name) || ' Systems!! ' || p_brand || ' (group) ' || lower(p_type) || ' ' || lower(p_type) || ' -'")} AS label
FROM part""",
}
ORACLE.update(TEXT_ORACLE)


# ---------------------------------------------------------------- profiles, rules, labels

from .config import (BROAD_RULES as _BR, BROAD_STRIP_SUFFIXES as _BSS, BROAD_UMBRELLAS as _BU,  # noqa: E402
                     CACHE_VERSION as _CV, HEAD_RULES as _HR, LAB_SUFFIX_RULES as _LR, PROFILE_CAPS as _CAPS,
                     ROLE_HINTS as _RH, ROLE_STEMS as _RS, VALID_SUFFIXES as _VS)

_ROLE_KEYS = [k for k, _ in _RH]
_ROLE_SUF = [v for _, v in _RH]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _first_match(blob: str, rules, default: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({blob}, {_q(p)}) THEN {_q(v)}" for p, v in rules) + \
        f" ELSE {default} END"


def _fmt2(c: str, t: str) -> str:
    q = f"(100 * ({c}) // ({t}))"
    r2 = f"((100 * ({c}) - {q} * ({t})) * 2)"
    h = f"(CASE WHEN {r2} > ({t}) THEN {q} + 1 WHEN {r2} < ({t}) THEN {q} ELSE CASE WHEN {q} % 2 = 0 THEN {q} ELSE {q} + 1 END END)"
    return h


def _ratio2(c: str, t: str) -> str:
    h = _fmt2(c, t)
    return f"(CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0'))"


def _norm_alnum(x: str) -> str:
    return _strip(f"regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')")


def _enforce(label: str, texts: str, rules=_BR, umbrellas=_BU) -> str:
    import re as _re

    def body(lab):
        def inner(base):
            whens = " ".join(
                f"WHEN contains({base}, {_q(_re.sub(r'[^a-z0-9]+', ' ', u.lower()).strip())}) OR "
                f"contains({_q(_re.sub(r'[^a-z0-9]+', ' ', u.lower()).strip())}, {base}) THEN {_q(u)}"
                for u in umbrellas)
            return f"(CASE {whens} ELSE {_title(lab)} END)"
        return _let(_norm_alnum(lab), inner)
    lab0 = (f"(CASE WHEN {label} = '' OR list_contains({BAN_SQL}, lower({label})) THEN "
            f"{_first_match(f'lower({texts})', rules, _q('Specialist Sector'))} ELSE {label} END)")
    return _let(lab0, body)


def _words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WSC}+'), lambda w: w <> '')"


def _force(label: str, level: str, head: str, suffix: str, texts: str) -> str:
    import re as _re
    if level == "Broad":
        def broad(lab):
            h = _title(_enforce(lab, texts))
            h = _strip(f"regexp_replace({h}, '(?i)\\b({'|'.join(_BSS)})\\b', '', 'g')")
            return _let(_sanitize(h), lambda hh: f"array_to_string({_words(hh)}[1:4], ' ')")
        return _let(_sanitize(label), broad)

    def with_lab(lab):
        found = "(CASE " + " ".join(
            f"WHEN regexp_matches({lab}, {_q('(?i)' + _WB + x + _WB)}) THEN {_q(x)}"
            for x in _VS) + " END)"

        def with_found(fd):
            before = "(CASE " + " ".join(
                f"WHEN {fd} = {_q(x)} THEN regexp_extract({lab}, "
                f"{_q('(?i)^(.*?)' + _WB + _re.escape(x) + _WB)}, 1)" for x in _VS) + " END)"

            def with_hp(hp):
                named = (f"(CASE WHEN {fd} IS NOT NULL AND {hp} <> '' AND NOT list_contains({BAN_SQL}, lower({hp})) "
                         f"THEN {hp} END)")

                def with_h0(h0):
                    h = (f"(CASE WHEN len({_words(h0)}) > 0 THEN array_to_string({_words(h0)}[1:3], ' ') "
                         f"ELSE 'Specialist' END)")

                    def with_out(out):
                        def with_words(words):
                            tail = (f"(CASE WHEN contains({out}, 'Suppliers') AND contains({out}, 'Distributors') "
                                    f"THEN 2 ELSE 1 END)")
                            cut = (f"array_to_string(list_concat({words}[1:greatest(1, 5 - {tail})], "
                                   f"{words}[len({words}) - {tail} + 1:len({words})]), ' ')")
                            out2 = f"(CASE WHEN len({words}) > 5 THEN {cut} ELSE {out} END)"
                            return (f"regexp_replace({out2}, '(?i)\\b(Specialist|Specialists)\\b\\s+"
                                    f"\\b(Specialist|Specialists)\\b', 'Specialists', 'g')")
                        return _let(f"string_split({out}, ' ')", with_words)
                    return _let(_sanitize(_title(f"({h} || ' ' || coalesce({fd}, {suffix}))")), with_out)
                return _let(f"coalesce({named}, {head})", with_h0)
            return _let(_strip(before), with_hp)
        return _let(found, with_found)
    return _let(_sanitize(label), with_lab)


def _profile_ctes(p: str, level: str) -> str:
    """CTEs ``{p}prof`` etc.: one row per cluster (nation for Sub, region for Broad)."""
    key = "c.c_nationkey" if level == "Sub" else "n.n_regionkey"
    caps = {"industries": ("industry", False), "services": ("services", False), "summaries": ("ai_summary", False),
            "company_names": ("company_name", True), "business_models": ("business_model", False)}
    parts = [f"""{p}asg AS (SELECT d.doc_id AS id, CAST(coalesce({key}, -1) AS INTEGER) AS cid
  FROM documents d LEFT JOIN customer c ON c.c_custkey = d.doc_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""]
    for name, (col, keep) in caps.items():
        cond = "" if keep else f"WHERE {_strip('r.' + col)} <> ''"
        parts.append(f"""{p}f_{name} AS (SELECT cid, list(v ORDER BY id) AS {name} FROM (
  SELECT a.cid, r.id, r.{col} AS v, row_number() OVER (PARTITION BY a.cid ORDER BY r.id) AS rn
  FROM records r JOIN {p}asg a USING (id) {cond}) WHERE rn <= {_CAPS[name]} GROUP BY cid)""")
    parts.append(f"""{p}kw AS (SELECT a.cid, r.id, s.kw, s.pos FROM records r JOIN {p}asg a USING (id),
  unnest(list_transform({_to_list('r.keywords')}, lambda x, i: {{'kw': x, 'pos': i}})) AS u(s))""")
    parts.append(f"""{p}kwc AS (SELECT cid, kw, count(*) AS cnt, min(id * 1000000 + pos) AS first FROM {p}kw GROUP BY cid, kw)""")
    parts.append(f"""{p}kwt AS (SELECT cid, kw, cnt, row_number() OVER (PARTITION BY cid ORDER BY cnt DESC, first) AS rk FROM {p}kwc)""")
    parts.append(f"""{p}f_kw AS (SELECT cid, list(kw ORDER BY rk) AS top_keywords FROM {p}kwt WHERE rk <= 40 GROUP BY cid)""")
    keys = "[" + ", ".join(_q(k) for k in _ROLE_KEYS) + "]"
    roles_toks = _tokens(f"array_to_string({_to_list('r.roles')}, ' ')")
    model_toks = _tokens(f"array_to_string({_to_list('r.business_model')}, ' ')")
    toks = f"list_concat({roles_toks}, {model_toks})"
    parts.append(f"""{p}rt AS (SELECT a.cid, list_filter({toks}, lambda t: list_contains({keys}, t)) AS rt,
  ' ' || lower(r.services) || ' ' AS sv, ' ' || lower(r.ai_summary) || ' ' AS sm FROM records r JOIN {p}asg a USING (id))""")
    aggs = [f"sum(len(list_filter(rt, lambda t: t = {_q(k)}))) AS t{i}" for i, k in enumerate(_ROLE_KEYS)]
    aggs += [f"bool_or(contains(sv, {_q(s)}) OR contains(sm, {_q(s)})) AS s{j}" for j, (s, _) in enumerate(_RS)]
    parts.append(f"""{p}rca AS (SELECT cid, {', '.join(aggs)} FROM {p}rt GROUP BY cid)""")
    cnts = []
    for i, k in enumerate(_ROLE_KEYS):
        e = f"CAST(coalesce(t{i}, 0) AS BIGINT)"
        for j, (_, role) in enumerate(_RS):
            if role == k:
                e += f" + CASE WHEN s{j} THEN 1 ELSE 0 END"
        cnts.append(e)
    parts.append(f"""{p}rc AS (SELECT cid, [{', '.join(cnts)}] AS role_counts FROM {p}rca)""")
    parts.append(f"""{p}base AS (SELECT s.cid, s.size, coalesce(k.top_keywords, []::VARCHAR[]) AS top_keywords,
  {', '.join(f'coalesce({p}f_{n}.{n}, []::VARCHAR[]) AS {n}' for n in caps)},
  rc.role_counts, greatest(1, list_sum(rc.role_counts)) AS role_total
  FROM (SELECT cid, count(*) AS size FROM {p}asg GROUP BY cid) s
  LEFT JOIN {p}f_kw k USING (cid) {' '.join(f'LEFT JOIN {p}f_{n} USING (cid)' for n in caps)}
  LEFT JOIN {p}rc rc USING (cid))""")
    if level == "Sub":
        par = f"""{p}par AS (SELECT DISTINCT CAST(c.c_nationkey AS INTEGER) AS cid, CAST(n.n_regionkey AS INTEGER) AS parent_id,
  'Region ' || CAST(n.n_regionkey AS VARCHAR) AS parent_label
  FROM documents d JOIN customer c ON c.c_custkey = d.doc_id JOIN nation n ON n.n_nationkey = c.c_nationkey)"""
    else:
        par = f"""{p}par AS (SELECT DISTINCT cid, CAST(NULL AS INTEGER) AS parent_id, CAST(NULL AS VARCHAR) AS parent_label FROM {p}asg)"""
    parts.append(par)
    texts = "array_to_string(list_concat(services, summaries, industries), ' ')"
    hblob = f"lower({texts} || ' ' || array_to_string(top_keywords, ' '))"
    parts.append(f"""{p}b2 AS (SELECT b.*, pr.parent_id, pr.parent_label, {texts} AS texts, {hblob} AS hblob,
  lower(array_to_string(list_concat(services, summaries, industries, top_keywords), ' ')) AS sblob
  FROM {p}base b LEFT JOIN {p}par pr USING (cid))""")
    gh = _gram_head_sql(f"{p}b2", "cid", "hblob").replace("tk AS", f"{p}tk AS").replace("FROM tk", f"FROM {p}tk") \
        .replace("gr AS", f"{p}gr AS").replace("FROM gr", f"FROM {p}gr").replace("grc AS", f"{p}grc AS") \
        .replace("FROM grc", f"FROM {p}grc").replace("gbest AS", f"{p}gbest AS")
    parts.append(gh)
    sufs = "[" + ", ".join(_q(s) for s in _ROLE_SUF) + "]"
    head = _first_match("hblob", _HR, "CASE WHEN coalesce(gram_head, '') <> '' THEN gram_head ELSE 'Specialist' END")
    suffix = _first_match("sblob", _LR, f"{sufs}[list_position(role_counts, list_max(role_counts))]")
    parts.append(f"""{p}b3 AS (SELECT b.*, g.gram_head, {head} AS head, {suffix} AS suffix
  FROM {p}b2 b LEFT JOIN {p}gbest g ON g.k = b.cid)""")
    order = sorted(range(len(_ROLE_KEYS)), key=lambda i: f"{_ROLE_KEYS[i]}:")
    ratios = " || ',' || ".join(f"{_q(_ROLE_KEYS[i] + ':')} || {_ratio2(f'role_counts[{i + 1}]', 'role_total')}"
                                for i in order)
    ck = (f"concat_ws('|', {_q(_CV)}, '{level}', CAST(cid AS VARCHAR), coalesce(parent_label, ''), CAST(size AS VARCHAR), "
          f"array_to_string(top_keywords[1:12], ','), array_to_string(company_names[1:6], ','), "
          f"array_to_string(industries[1:6], ','), array_to_string(services[1:6], ','), {ratios}, sha256(concat_ws('|', "
          f"array_to_string(top_keywords, ','), array_to_string(company_names, ','), array_to_string(industries, ','), "
          f"array_to_string(services, ','))))")
    if level == "Broad":
        fb = _title(_enforce("head", "texts"))
    else:
        fb = _force("(head || ' ' || suffix)", "Sub", "head", "suffix", "texts")
    parts.append(f"""{p}prof AS (SELECT *, {ck} AS cache_key, {fb} AS fallback FROM {p}b3)""")
    return ",\n".join(parts)


def _with_prof(final: str, levels=("Sub",)) -> str:
    ctes = [RECORDS] + [_profile_ctes("s_" if lv == "Sub" else "b_", lv) for lv in levels]
    return "WITH " + ",\n".join(ctes) + "\n" + final


def _context() -> str:
    pct = lambda i: _fmt2(f"role_counts[{i + 1}]", "role_total")
    items = ", ".join(f"{{'nc': -role_counts[{i + 1}], 'i': {i}, 's': {_q(k + ':')} || CAST({pct(i)} AS VARCHAR) || '%'}}"
                      for i, k in enumerate(_ROLE_KEYS))
    mix = f"'Role mix: ' || array_to_string(list_transform(list_sort([{items}])[1:6], lambda x: x.s), ', ')"
    return ("concat_ws(chr(10), 'Level: Sub' || CASE WHEN coalesce(parent_label, '') <> '' THEN ' (child of ''' || parent_label || ''')' ELSE '' END, "
            "'Size: ' || CAST(size AS VARCHAR), "
            "CASE WHEN len(company_names) > 0 THEN 'Examples: ' || array_to_string(company_names, ', ') END, "
            "CASE WHEN len(services) > 0 THEN 'Services: ' || array_to_string(services, '; ') END, "
            "CASE WHEN len(top_keywords) > 0 THEN 'Key terms: ' || array_to_string(top_keywords[1:16], ', ') END, "
            f"{mix})")


_FITTED = ((r"\b(ring|bolt|gear)\b", "Fasteners & Gears"), (r"\b(widget|gizmo)\b", "Widgets & Gadgets"),
           (r"\b(machinery|building)\b", "Machinery & Building"))
_FITTED_U = ("Fasteners & Gears", "Widgets & Gadgets", "Machinery & Building", "Household Goods")


def _dedupe_sql() -> str:
    blob = "array_to_string(list_concat(services, summaries, top_keywords), ' ')"
    return _with_prof(f""",
lab AS (SELECT cid, parent_id, fallback AS label, count(*) OVER (PARTITION BY parent_id, fallback) > 1 AS dup FROM s_prof),
tk2 AS (SELECT l.cid, l.parent_id, l.label, {_tokens(blob)} AS t FROM lab l JOIN s_prof p USING (cid) WHERE l.dup),
g2 AS (SELECT DISTINCT cid, parent_id, label, gram FROM tk2, unnest(list_concat({_ngrams('t', 2)}, {_ngrams('t', 3)})) AS u(gram)
       WHERE NOT list_has_any(string_split(gram, ' '), {BAN_SQL})),
own AS (SELECT parent_id, label, gram, count(DISTINCT cid) AS nc, min(cid) AS cid FROM g2 GROUP BY parent_id, label, gram),
best AS (SELECT cid, gram FROM (SELECT cid, gram, row_number() OVER (PARTITION BY cid ORDER BY len(string_split(gram, ' ')) DESC, gram) AS r
         FROM own WHERE nc = 1) WHERE r = 1),
spec AS (SELECT cid, array_to_string(list_transform(string_split(gram, ' '), lambda w: {_pytitle('w')}), ' ') AS spec FROM best)
SELECT CAST(l.cid AS BIGINT) AS cluster, CAST(l.parent_id AS BIGINT) AS parent,
       CASE WHEN l.dup AND s.spec IS NOT NULL AND s.spec <> '' THEN {_sanitize("l.label || ' (' || s.spec || ')'")} ELSE l.label END AS label
FROM lab l LEFT JOIN spec s USING (cid)""".lstrip().replace(",\nlab AS", "lab AS", 0)).replace("\n,\nlab AS", ",\nlab AS")


_IND1 = "coalesce(industries[1], '')"
_RAW_LABEL = "coalesce(services[1] || ' Integrators and suppliers & distributors', '')"

RULE_ORACLE = {
    "first_n": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, " + ", ".join(
        f"array_to_string({n}, '|') AS {n}" for n in ("industries", "services", "summaries", "company_names",
                                                       "business_models")) + " FROM s_base"),
    "top_keywords": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, CAST(rk AS BIGINT) AS rank, kw, CAST(cnt AS BIGINT) AS cnt "
                               "FROM s_kwt WHERE rk <= 40"),
    "role_ratios": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, array_to_string(role_counts, ',') AS counts, "
                              "CAST(role_total AS BIGINT) AS total, " + " || ',' || ".join(
                                  f"{_q(_ROLE_KEYS[i] + ':')} || {_ratio2(f'role_counts[{i + 1}]', 'role_total')}"
                                  for i in sorted(range(10), key=lambda i: _ROLE_KEYS[i] + ':')) + " AS ratios FROM s_base"),
    "cluster_profile": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, CAST(size AS BIGINT) AS size, "
                                  "array_to_string(top_keywords, '|') AS top_keywords, array_to_string(services, '|') AS services, "
                                  "array_to_string(company_names, '|') AS company_names, array_to_string(industries, '|') AS industries FROM s_prof"),
    "census": """SELECT CAST(c.c_nationkey AS BIGINT) AS cluster, n.n_name AS name, CAST(count(*) AS BIGINT) AS count
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY c.c_nationkey, n.n_name ORDER BY count DESC, cluster LIMIT 20""",
    "umbrella": _with_prof(f"SELECT CAST(cid AS BIGINT) AS cluster, {_first_match('lower(texts)', _BR, _q('Specialist Sector'))} AS default_rules, "
                           f"{_first_match('lower(texts)', _FITTED, _q('Specialist Sector'))} AS fitted_rules FROM s_prof"),
    "enforce_umbrella": _with_prof(f"SELECT CAST(cid AS BIGINT) AS cluster, {_enforce(_IND1, 'texts')} AS default_sector, "
                                   f"{_enforce(_IND1, 'texts', _FITTED, _FITTED_U)} AS fitted_sector, "
                                   f"{_enforce('head', 'texts')} AS head_sector FROM s_prof"),
    "canonical_head": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, gram_head, head FROM s_prof"),
    "role_suffix": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, suffix FROM s_prof"),
    "head_suffix": _with_prof(f"SELECT CAST(cid AS BIGINT) AS cluster, "
                              f"{_force(_RAW_LABEL, 'Sub', 'head', 'suffix', 'texts')} AS sub_label, "
                              f"{_force('head', 'Broad', 'head', 'suffix', 'texts')} AS broad_label FROM s_prof"),
    "fallback_label": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, 'Broad' AS level, fallback AS label FROM b_prof "
                                 "UNION ALL SELECT CAST(cid AS BIGINT) AS cluster, 'Sub' AS level, fallback AS label FROM s_prof",
                                 ("Sub", "Broad")),
    "cache_key": _with_prof("SELECT CAST(cid AS BIGINT) AS cluster, cache_key FROM s_prof"),
    "context_text": _with_prof(f"SELECT CAST(cid AS BIGINT) AS cluster, {_context()} AS context FROM s_prof"),
    "sibling_dedupe": _dedupe_sql(),
    "label_attach": _with_prof("""SELECT a.id, s.fallback AS sub_label, b.fallback AS broad_label
FROM s_asg a LEFT JOIN s_prof s ON s.cid = a.cid LEFT JOIN b_prof b ON b.cid = s.parent_id""", ("Sub", "Broad")),
    "cache_probe": _with_prof("""SELECT CAST(b.cid AS BIGINT) AS cluster, 'Broad' AS level, c.label IS NOT NULL AS hit, coalesce(c.label, b.fallback) AS label
FROM b_prof b LEFT JOIN (SELECT cache_key, 'cached ' || fallback AS label FROM b_prof) c USING (cache_key)
UNION ALL
SELECT CAST(s.cid AS BIGINT), 'Sub', c.label IS NOT NULL, coalesce(c.label, s.fallback)
FROM s_prof s LEFT JOIN (SELECT cache_key, 'cached ' || fallback AS label FROM b_prof) c USING (cache_key)""", ("Sub", "Broad")),
}
ORACLE.update(RULE_ORACLE)


# ---------------------------------------------------------------- clustering operators

_XL = f"""x AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS label, {_norm('CAST(embedding AS DOUBLE[])')} AS v
       FROM embeddings),
xe AS (SELECT id, label, p, v[p] AS e FROM x, range(1, 65) t(p)),
cm AS (SELECT label, p, avg(e) AS m, count(*) AS size FROM xe GROUP BY label, p),
cn AS (SELECT label, size, list(m ORDER BY p) AS mv FROM cm GROUP BY label, size),
cent AS (SELECT label, size, {_norm('mv')} AS c FROM cn)"""


def _dense_rank_sql(src: str, part: str) -> str:
    return f"SELECT *, dense_rank() OVER (PARTITION BY {part} ORDER BY label) - 1 AS nl FROM {src}"


CLUSTER_ORACLE = {
    "centroids": f"""WITH {_XL}
SELECT CAST(label AS BIGINT) AS label, CAST(size AS BIGINT) AS size, CAST(p - 1 AS BIGINT) AS pos, {r4('c[p]')} AS x
FROM cent, range(1, 65) t(p)""",
    "refine_centroid": f"""WITH {_XL},
sims AS (SELECT x.id, x.label AS cur, cent.label AS cl, list_inner_product(x.v, cent.c) AS sim FROM x JOIN cent ON TRUE),
best AS (SELECT id, max(sim) AS bs, max(CASE WHEN cl = cur THEN sim END) AS cs FROM sims GROUP BY id),
b2 AS (SELECT s.id, s.cur, min(s.cl) AS bl, b.bs, b.cs FROM sims s JOIN best b USING (id) WHERE s.sim = b.bs GROUP BY s.id, s.cur, b.bs, b.cs)
SELECT id, CAST(CASE WHEN bs - cs > 0.025 THEN bl ELSE cur END AS BIGINT) AS label FROM b2""",
    "merge_small": f"""WITH {_XL},
sm AS (SELECT label, c FROM cent WHERE size < 50),
lg AS (SELECT label, c FROM cent WHERE size >= 50),
pr AS (SELECT sm.label AS s, lg.label AS t, list_inner_product(sm.c, lg.c) AS sim FROM sm JOIN lg ON TRUE),
pb AS (SELECT s, min(t) AS t FROM (SELECT *, max(sim) OVER (PARTITION BY s) AS mx FROM pr WHERE sim > -1.0) WHERE sim = mx GROUP BY s),
mv AS (SELECT x.id, coalesce(pb.t, x.label) AS label FROM x LEFT JOIN pb ON pb.s = x.label),
rl AS (SELECT id, dense_rank() OVER (ORDER BY label) - 1 AS nl FROM mv)
SELECT id, CAST(CASE WHEN (SELECT count(*) FROM sm) > 0 THEN nl ELSE (SELECT label FROM x WHERE x.id = rl.id) END AS BIGINT) AS label FROM rl""",
    "relabel": """WITH l AS (SELECT vec_id AS id, label AS g, CASE WHEN embedding[1] > 0 THEN 7 ELSE 3 END AS label FROM embeddings)
SELECT id, CAST(dense_rank() OVER (PARTITION BY g ORDER BY label) - 1 AS BIGINT) AS label FROM l""",
    "child_numbering": """WITH l AS (SELECT vec_id AS id, label AS parent, CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS label FROM embeddings),
pairs AS (SELECT DISTINCT parent, label FROM l),
num AS (SELECT parent, label, dense_rank() OVER (ORDER BY parent, label) - 1 AS child FROM pairs)
SELECT l.id, CAST(num.child AS BIGINT) AS child FROM l JOIN num USING (parent, label)""",
    "pad_dims": f"""WITH z AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[])[1:label] AS z FROM embeddings WHERE label > 0),
w AS (SELECT max(len(z)) AS w FROM z),
a AS (SELECT e.vec_id AS id, z.z FROM embeddings e LEFT JOIN z ON z.id = e.vec_id)
SELECT id, CAST(p - 1 AS BIGINT) AS pos, {r4('coalesce(z[p], 0.0)')} AS x FROM a, w, range(1, w.w + 1) t(p)""",
    "dims_to_columns": f"""SELECT vec_id AS id, {', '.join(f"{r4(f'embedding[{i}]')} AS broad_dim{i}" for i in range(1, 5))},
  {r4(' + '.join(f'CAST(embedding[{i}] AS DOUBLE)' for i in range(1, 5)))} AS dims_sum FROM embeddings""",
    "mean_pool": f"""WITH m AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v,
                     CASE WHEN embedding[1] > 0 THEN 1.0 ELSE 0.0 END AS mask FROM embeddings),
e AS (SELECT label, p, sum(v[p] * mask) AS s FROM m, range(1, 65) t(p) GROUP BY label, p),
ms AS (SELECT label, sum(mask) AS msum FROM m GROUP BY label),
pl AS (SELECT e.label, list(s / greatest(msum, 1e-9) ORDER BY p) AS pv FROM e JOIN ms USING (label) GROUP BY e.label),
n AS (SELECT label, {_norm('pv')} AS x FROM pl)
SELECT CAST(label AS BIGINT) AS label, CAST(p - 1 AS BIGINT) AS pos, {r4('x[p]')} AS x FROM n, range(1, 65) t(p)""",
    "concat_views": f"""WITH {_slices_view()},
o AS (SELECT * FROM (VALUES ('v1', 0), ('v2', 1), ('v3', 2), ('v5', 3), ('v4', 4), ('vloc', 5)) t(view, o)),
c AS (SELECT id, flatten(list(x ORDER BY o.o)) AS v FROM vecs JOIN o USING (view) GROUP BY id),
n AS (SELECT id, {_norm('v')} AS v FROM c)
SELECT id, CAST(p - 1 AS BIGINT) AS pos, {r4('v[p]')} AS x FROM n, range(1, len(v) + 1) t(p)""",
    "balance_stats": f"""WITH c AS (SELECT label, count(*) AS c FROM embeddings GROUP BY label)
SELECT {r4('max(c) / sum(c)')} AS big_frac, {r4('stddev_pop(c) / (avg(c) + 1e-9)')} AS imb FROM c""",
    "silhouette": f"""WITH {_XL},
d AS (SELECT a.id, a.label AS la, b.label AS lb, greatest(1.0 - list_inner_product(a.v, b.v), 0.0) AS dist
      FROM x a JOIN x b ON a.id <> b.id),
per AS (SELECT id, la, lb, avg(dist) AS md FROM d GROUP BY id, la, lb),
ab AS (SELECT id, max(CASE WHEN la = lb THEN md END) AS a, min(CASE WHEN la <> lb THEN md END) AS b FROM per GROUP BY id)
SELECT {r4('avg((b - a) / greatest(a, b))')} AS silhouette FROM ab""",
}
CLUSTER_ORACLE["k_score"] = CLUSTER_ORACLE["silhouette"].replace(
    f"SELECT {r4('avg((b - a) / greatest(a, b))')} AS silhouette FROM ab",
    f""", sil AS (SELECT avg((b - a) / greatest(a, b)) AS sil FROM ab),
cc AS (SELECT label, count(*) AS c FROM embeddings GROUP BY label),
st AS (SELECT max(c) / sum(c) AS big, stddev_pop(c) / (avg(c) + 1e-9) AS imb, count(*) AS k FROM cc)
SELECT {r4('sil + 0.13 * ln(k) - 0.07 * imb - CASE WHEN big > 0.35 THEN 0.35 ELSE 0.0 END')} AS score FROM sil, st""")
ORACLE.update(CLUSTER_ORACLE)


# ---------------------------------------------------------------- iterative operators: what must hold, computed from the tables

_N = "(SELECT count(*) FROM embeddings)"
INVARIANT_ORACLE = {
    "spectral_embed": f"""SELECT vec_id AS id, CAST(least(14, {_N} - 1) AS BIGINT) AS width, 1.0 AS norm,
  CAST(0 AS BIGINT) AS out_of_order, 0.0 AS residual FROM embeddings""",
    "spectral_distributed": """WITH g AS (SELECT CAST(label AS BIGINT) AS label, count(*) AS n FROM embeddings GROUP BY label)
SELECT label, n, CAST(least(6, n - 1) AS BIGINT) AS eigenpairs, CAST(least(6, n - 1) * (least(6, n - 1) + 1) // 2 AS BIGINT) AS orthonormal FROM g""",
    "choose_k": f"""SELECT CAST(k AS BIGINT) AS k, 0.0 AS beyond_parts, TRUE AS in_range, 0.0 AS silhouette_gap
FROM range(6, least(14, {_N} - 1) + 1) t(k) WHERE k < {_N}""",
    "kmeans_level": "SELECT vec_id AS id, CAST(0 AS BIGINT) AS label_gap, FALSE AS far, CAST(10 AS BIGINT) AS clusters, TRUE AS tight FROM embeddings",
    "sample_cap": """SELECT CAST(label AS BIGINT) AS label, CAST(least(count(*), 20) AS BIGINT) AS drawn,
  CAST(least(count(*), 20) AS BIGINT) AS ids FROM embeddings GROUP BY label""",
    "run_level": "SELECT vec_id AS id, CAST(0 AS BIGINT) AS label_gap, TRUE AS sizes_ok, TRUE AS several, TRUE AS tight FROM embeddings",
    "hierarchy": """SELECT vec_id AS id, CAST(1 AS BIGINT) AS sub_parents, CAST(1 AS BIGINT) AS niche_parents,
  CAST(0 AS BIGINT) AS cluster_broad_gap, CAST(0 AS BIGINT) AS cluster_sub_gap, CAST(0 AS BIGINT) AS cluster_niche_gap,
  CAST(1 AS BIGINT) AS broad_dims_widths, CAST(1 AS BIGINT) AS sub_dims_widths, CAST(1 AS BIGINT) AS niche_dims_widths,
  TRUE AS several, TRUE AS tighter FROM embeddings""",
    "text_embed": "SELECT doc_id AS id, CAST(least(64, (SELECT count(*) FROM documents)) AS BIGINT) AS width, 1.0 AS norm FROM documents",
    "pca_views": """SELECT d.doc_id AS id, v.view, CAST(least(v.w, (SELECT count(*) FROM documents)) AS BIGINT) AS width
FROM documents d, (VALUES %s) v(view, w)""" % ", ".join(f"('{v}', {w})" for v, w in PCA_DIMS.items()),
    "knn_lsh": f"""SELECT vec_id AS src, CAST(least(10, {_N} - 1) AS BIGINT) AS neighbours, CAST(least(10, {_N} - 1) AS BIGINT) AS last_rank,
  CAST(0 AS BIGINT) AS selves, 0.0 AS distance_error,
  TRUE AS recall_ok FROM embeddings""",
    "taxonomy": f"""WITH {RECORDS} SELECT id, company_name, location, TRUE AS named, TRUE AS clustered, TRUE AS dims_match,
  CAST(32 AS BIGINT) AS loc_dims, TRUE AS several FROM records""",
}
ORACLE.update(INVARIANT_ORACLE)

# C5 by definition: the state is (list of cluster sums, sizes, labels' owners); one step merges the best pair
_MERGE = f"""RECURSIVE x AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS label, {_norm('CAST(embedding AS DOUBLE[])')} AS v FROM embeddings),
xe AS (SELECT label, p, sum(v[p]) AS s, count(*) AS n FROM x, range(1, 65) t(p) GROUP BY label, p),
c0 AS (SELECT label, any_value(n) AS n, list(s ORDER BY p) AS s FROM xe GROUP BY label),
st AS (SELECT 0 AS step, (SELECT list(struct_pack(l := label, n := n, s := s, m := [label]) ORDER BY label) FROM c0) AS cs
  UNION ALL
  SELECT step + 1, list_sort(list_concat(list_filter(cs, lambda c: c.l <> b.la AND c.l <> b.lb),
      [struct_pack(l := CASE WHEN b.na >= b.nb THEN b.la ELSE b.lb END, n := b.na + b.nb,
                   s := list_transform(range(1, len(b.sa) + 1), lambda i: b.sa[i] + b.sb[i]), m := list_concat(b.ma, b.mb))]))
  FROM (SELECT step, cs, (SELECT struct_pack(sim := sim, la := a.l, lb := b.l, na := a.n, nb := b.n, sa := a.s, sb := b.s, ma := a.m, mb := b.m)
               FROM (SELECT a, b, list_inner_product(a.s, b.s) / sqrt(list_inner_product(a.s, a.s)) / sqrt(list_inner_product(b.s, b.s)) AS sim
                     FROM unnest(cs) ta(a), unnest(cs) tb(b) WHERE a.l < b.l) ORDER BY sim DESC, a.l, b.l LIMIT 1) AS b FROM st)
  WHERE b IS NOT NULL AND b.sim >= 0.3),
fin AS (SELECT cs FROM st ORDER BY step DESC LIMIT 1),
new AS (SELECT c.l, c.m, row_number() OVER (ORDER BY c.l) - 1 AS nl FROM fin, unnest(cs) t(c)),
own AS (SELECT unnest(m) AS label, nl FROM new)
SELECT x.id, CAST(own.nl AS BIGINT) AS label FROM x JOIN own USING (label)"""
ORACLE["merge_duplicates"] = f"WITH {_MERGE}"


# ---------------------------------------------------------------- projection, census of levels, scan and cache

def _hex7(digest: str, at: int) -> str:
    """Seven hexadecimal digits as a number."""
    return " + ".join(f"(strpos('0123456789abcdef', substr({digest}, {at + i}, 1)) - 1) * {16 ** (6 - i)}" for i in range(7))


ORACLE["text_projection"] = f"""WITH d AS (SELECT doc_id AS id, CASE WHEN trim(coalesce(text, '')) = '' THEN '__blank__' ELSE lower(text) END AS t FROM documents),
w AS (SELECT id, list_filter(regexp_split_to_array(t, '[^\\p{{L}}\\p{{N}}_]+'), lambda x: x <> '') AS l FROM d),
tk AS (SELECT id, unnest(CASE WHEN len(l) > 0 THEN l ELSE ['__blank__'] END) AS word FROM w),
tf AS (SELECT id, word, count(*) AS tf FROM tk GROUP BY id, word),
df AS (SELECT word, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY word),
dr AS (SELECT word, idf, md5('42:' || draw || ':' || word) AS m FROM df, range(4) r(draw)),
pl AS (SELECT word, idf, CAST(({_hex7('m', 1)}) % 32 AS BIGINT) AS pos, CASE WHEN ({_hex7('m', 8)}) % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign FROM dr),
x AS (SELECT id, pos, sum(sign * tf * idf / 2.0) AS x FROM tf JOIN pl USING (word) GROUP BY id, pos),
n AS (SELECT id, sqrt(sum(x * x)) AS n FROM x GROUP BY id)
SELECT d.id, CAST(p AS BIGINT) AS pos, {r4('coalesce(x.x / nullif(n.n, 0), 0.0)')} AS x
FROM d JOIN range(32) t(p) ON TRUE LEFT JOIN x ON x.id = d.id AND x.pos = p LEFT JOIN n ON n.id = d.id"""

ORACLE["level_census"] = """WITH j AS (SELECT coalesce(n.n_regionkey, -1) AS r, coalesce(c.c_nationkey, -1) AS nk, coalesce(c.c_mktsegment, '') AS seg
  FROM documents d LEFT JOIN customer c ON c.c_custkey = d.doc_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
h AS (SELECT dense_rank() OVER (ORDER BY r) - 1 AS broad, dense_rank() OVER (ORDER BY r, nk) - 1 AS sub, dense_rank() OVER (ORDER BY r, nk, seg) - 1 AS niche FROM j),
s AS (SELECT 'broad' AS level, broad AS cluster, count(*) AS c FROM h GROUP BY broad UNION ALL SELECT 'sub', sub, count(*) FROM h GROUP BY sub
      UNION ALL SELECT 'niche', niche, count(*) FROM h GROUP BY niche),
t AS (SELECT level, count(*) AS clusters, sum(c) AS rows FROM s GROUP BY level),
k AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY c DESC, cluster) AS place FROM s)
SELECT k.level, CAST(t.clusters AS BIGINT) AS clusters, CAST(t.rows AS BIGINT) AS rows, CAST(place AS BIGINT) AS place, CAST(cluster AS BIGINT) AS cluster,
  k.level || ' ' || cluster AS name, CAST(c AS BIGINT) AS count FROM k JOIN t USING (level) WHERE place <= 20"""

ORACLE["csv_scan"] = """SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand || chr(10) || '"' || p_type || '", x' AS about,
  CASE WHEN p_partkey % 3 IN (0, 1) THEN NULL ELSE p_type END AS kind FROM part
UNION ALL SELECT CAST(-c_custkey AS VARCHAR), c_name, c_mktsegment, NULL FROM customer"""

ORACLE["cache_snapshots"] = """SELECT 'k' || p_partkey AS cache_key, CASE WHEN p_partkey % 10 = 0 THEN 'tenth' WHEN p_partkey % 2 = 0 THEN p_type ELSE p_brand END AS label FROM part"""
