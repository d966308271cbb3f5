"""SQL counterparts of the queries, written for DuckDB and independent of the Spark expressions.

The fragments below are common table expressions that build on each other; every oracle lists the ones it needs.
"""

from __future__ import annotations

from catalog.queries import HEADS, MINHASH
from siftwork.functions import html, pii
from siftwork.functions.hashing import PRIME, SEED, minhash_family
from siftwork.functions.text import WS_CHARS, WS_CLASS
from siftwork.operators import classifiers as C
from siftwork.operators import tokens as K


def q(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


WS = f"[{WS_CLASS}]+"
WORD = f"[^{WS_CLASS}]+"


def strip(x: str) -> str:
    return f"trim({x}, {q(WS_CHARS)})"


def flat(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS)}, ' ', 'g'), ' ')"


def n_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {q(WORD)}))"


def normal(x: str) -> str:
    breaks = q(rf"[{WS_CLASS}\p{{P}}]+")
    return f"trim(regexp_replace(lower(strip_accents({x})), {breaks}, ' ', 'g'), ' ')"


def order_key(*parts: str, seed: int = SEED) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(parts)}))"


def length_reason(n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN 'empty' WHEN {n} < 50 THEN 'too_short' WHEN {n} > 100000 THEN 'too_long' END"


def with_(ctes: list[str], final: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + final


# -- masking -----------------------------------------------------------------------------------------------

_PHONE_CORE = (
    rf"\(?\p{{Nd}}{{3}}\)?[-.{WS_CLASS}]?\(?\p{{Nd}}{{3}}\)?[-.{WS_CLASS}]?\p{{Nd}}{{4}}"
)
_OCTET = r"(?:25[0-5]|2[0-4]\p{Nd}|1\p{Nd}\p{Nd}|[1-9]?\p{Nd})"
_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"


def _bounded(x: str, core: str, mask: str) -> str:
    """RE2 has no look-around: the neighbours are matched and put back; two passes catch shared neighbours."""
    pattern, put = q(rf"(^|[^\p{{Nd}}]){core}($|[^\p{{Nd}}])"), q(rf"\1{mask}\2")
    once = f"regexp_replace({x}, {pattern}, {put}, 'g')"
    return f"regexp_replace({once}, {pattern}, {put}, 'g')"


def mask_email(x: str) -> str:
    return f"regexp_replace({x}, {q(_EMAIL)}, {q(pii.EMAIL_MASK)}, 'g')"


def mask_phone(x: str) -> str:
    return _bounded(x, _PHONE_CORE, pii.PHONE_MASK)


def mask_ip(x: str) -> str:
    return _bounded(x, rf"(?:{_OCTET}\.){{3}}{_OCTET}", pii.IP_MASK)


def placeholders(after: str, before: str, mask: str) -> str:
    found = f"(len({{0}}) - len(replace({{0}}, {q(mask)}, ''))) // {len(mask)}"
    return f"CAST({found.format(after)} - {found.format(before)} AS INTEGER)"


def masked_ctes(source: str, text: str, name: str = "masked_docs") -> list[str]:
    return [
        f"m1 AS (SELECT *, {mask_email(text)} AS t1 FROM {source})",
        f"m2 AS (SELECT *, {mask_phone('t1')} AS t2 FROM m1)",
        f"m3 AS (SELECT *, {mask_ip('t2')} AS masked FROM m2)",
        f"{name} AS (SELECT *, {placeholders('t1', text, pii.EMAIL_MASK)} AS n_email, "
        f"{placeholders('t2', 't1', pii.PHONE_MASK)} AS n_phone, {placeholders('masked', 't2', pii.IP_MASK)} AS n_ip FROM m3)",
    ]


def _single_mask(mask_sql, mask: str) -> str:
    return (
        f"SELECT doc_id, masked, {placeholders('masked', 'text', mask)} AS n "
        f"FROM (SELECT doc_id, text, {mask_sql('text')} AS masked FROM documents)"
    )


# -- quality rules -----------------------------------------------------------------------------------------


def measured(source: str, text: str, name: str = "measured") -> list[str]:
    clitic = q(r"(?i)(n't|'(?:s|m|d|ll|re|ve))([^\p{L}\p{N}_]|$)")
    word = r"[\p{L}\p{M}\p{N}_]"
    plain = rf"\.\.\.|{word}+(?:['./-]{word}+|[,:]\p{{N}}{word}*)*|[^{WS_CLASS}]"
    token = rf"'(?i:s|m|d|ll|re|ve)\b|{plain}"
    return [
        f"tokenized AS (SELECT *, regexp_extract_all(regexp_replace({text}, {clitic}, ' \\1\\2', 'g'), {q(token)}) AS toks, "
        f"string_split({text}, chr(10)) AS lns FROM {source})",
        f"""{name} AS (SELECT *, len(toks) AS n_tokens,
          CASE WHEN len(toks) > 0 THEN list_sum(list_transform(toks, lambda x: len(x))) / len(toks) END AS mean_len,
          len(list_filter(lns, lambda x: ends_with(x, '...'))) / len(lns) AS ellipsis_share,
          CASE WHEN len(toks) > 0 THEN len(list_filter(toks, lambda x: regexp_matches(x, '\\p{{L}}'))) / len(toks) END AS alpha_share
          FROM tokenized)""",
    ]


FAILED_RULE = (
    "CASE WHEN n_tokens < 50 OR n_tokens > 100000 THEN 'token_count' WHEN mean_len < 3 OR mean_len > 10 THEN 'mean_length' "
    "WHEN ellipsis_share > 0.3 THEN 'ellipsis_lines' WHEN alpha_share < 0.8 THEN 'alphabetic' END"
)

# -- classifiers -------------------------------------------------------------------------------------------


def word_rows(name: str, source: str, text: str, keep: str) -> list[str]:
    """Lower-cased words, neighbouring pairs and the bias, one row each."""
    return [
        f"{name}_w AS (SELECT {keep}, regexp_extract_all(lower({text}), {q(WORD)}) AS w FROM {source})",
        f"""{name} AS (SELECT {keep}, unnest(list_concat([''], w,
          list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM {name}_w)""",
    ]


def trigram_rows(name: str, source: str, text: str, keep: str) -> list[str]:
    letters = f"' ' || trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g'), ' ') || ' '"
    return [
        f"{name}_s AS (SELECT {keep}, string_split({letters}, '') AS s FROM {source})",
        f"""{name} AS (SELECT {keep}, unnest(list_concat([''],
          list_transform(range(1, greatest(len(s) - 1, 1)), lambda i: s[i] || s[i + 1] || s[i + 2]))) AS feature FROM {name}_s)""",
    ]


def model_ctes(name: str, rows: str, heads: tuple[C.Head, ...], where: str = "TRUE") -> list[str]:
    """Counts per class, vocabulary and fixed-point log-probabilities."""
    pairs = [(h, i, c) for h in heads for i, c in enumerate(h.classes)]
    counts = ", ".join(f"count(*) FILTER ({h.label} = {q(c)}) AS {h.count(i)}" for h, i, c in pairs)
    totals = ", ".join(f"sum({h.count(i)}) FILTER (feature <> '') AS t_{h.count(i)}" for h, i, _ in pairs)
    weights = []
    for h, i, _ in pairs:
        docs = " + ".join(h.count(j) for j in range(len(h.classes)))
        weights.append(
            f"CAST(round(CASE WHEN feature = '' THEN ln(({h.count(i)} + 1) / ({docs} + {len(h.classes)})) "
            f"ELSE ln(({h.count(i)} + 1) / (t_{h.count(i)} + v)) END * {C.UNIT}) AS BIGINT) AS {h.weight(i)}"
        )
    return [
        f"{name}_c AS (SELECT feature, {counts}, count(*) AS total FROM {rows} WHERE {where} GROUP BY feature)",
        f"{name}_v AS (SELECT * FROM {name}_c WHERE total >= 2 OR feature = '')",
        f"{name}_t AS (SELECT {totals}, count(*) FILTER (feature <> '') AS v FROM {name}_v)",
        f"{name} AS (SELECT {name}_v.*, {', '.join(weights)} FROM {name}_v, {name}_t)",
    ]


def verdict(h: C.Head) -> str:
    sums = [f"s_{h.weight(i)}" for i in range(len(h.classes))]
    best = f"greatest({', '.join(sums)})"
    label = "CASE " + " ".join(f"WHEN {s} = {best} THEN {q(c)}" for s, c in zip(sums, h.classes, strict=True)) + " END"
    mass = " + ".join(f"exp(({s} - {best}) * {h.sharpness}::DOUBLE / (n_known * {float(C.UNIT)}::DOUBLE))" for s in sums)
    return f"{label} AS {h.label}_label, round(1 / ({mass}), 6) AS {h.label}_score"


def score_ctes(name: str, rows: str, model: str, heads: tuple[C.Head, ...], key: str = "doc_id") -> list[str]:
    sums = ", ".join(f"sum({h.weight(i)}) AS s_{h.weight(i)}" for h in heads for i in range(len(h.classes)))
    return [
        f"{name}_s AS (SELECT {key}, {sums}, count(*) AS n_known FROM {rows} JOIN {model} USING (feature) GROUP BY {key})",
        f"{name} AS (SELECT {key}, {', '.join(verdict(h) for h in heads)} FROM {name}_s)",
    ]


def softmax_ctes(classes: tuple[str, ...], label: str, rounds: int = 10, l2: float = 1e-3, unit: int = 1_000_000, scale: int = 1 << 30) -> list[str]:
    """Rounds of gradient and step over ``labelled``: the last weights are ``weights``; then the scores of all documents."""
    k = range(len(classes))
    number = "CASE " + label + " " + " ".join(f"WHEN {q(c)} THEN {i}" for i, c in enumerate(classes)) + " END"
    best = "greatest(" + ", ".join(f"z_{i} / (n * {unit})" for i in k) + ")"
    mass = [f"exp(z_{i} / (n * {unit}) - {best})" for i in k]
    whole = "(" + " + ".join(mass) + ")"
    margin = ", ".join(f"sum(c * w_{i})::DOUBLE AS z_{i}" for i in k)
    steps = [
        f"softmax_docs AS (SELECT doc_id, text, {number} AS y FROM labelled)",
        *word_rows("bag_rows", "softmax_docs", "text", "doc_id, y"),
        "bag AS (SELECT doc_id, y, feature, count(*) AS c FROM bag_rows WHERE y IS NOT NULL GROUP BY ALL)",
        "known AS (SELECT feature FROM bag GROUP BY feature HAVING sum(c) >= 2 OR feature = '')",
        "fit_rows AS MATERIALIZED (SELECT b.*, sum(c) OVER (PARTITION BY doc_id)::BIGINT AS n FROM bag b JOIN known USING (feature))",
        f"fit_0 AS MATERIALIZED (SELECT feature, sum(c * floor({float(scale)}::DOUBLE / n + 0.5)::BIGINT)::BIGINT AS mass, "
        + ", ".join(f"0::BIGINT AS w_{i}" for i in k) + " FROM fit_rows GROUP BY feature)",
    ]
    for r in range(rounds):
        residual = ", ".join(f"floor(({mass[i]} / {whole} - (y = {i})::INT) * {scale} / n + 0.5)::BIGINT AS r_{i}" for i in k)
        slope = lambda i: f"(g_{i}::DOUBLE / {scale} + w_{i} * ({l2}::DOUBLE / {unit}))"
        moved = ", ".join(
            f"w_{i} - floor({slope(i)} / (mass / (2.0::DOUBLE * {scale}) + {l2}::DOUBLE) * {unit} + 0.5)::BIGINT AS w_{i}" for i in k
        )
        steps += [
            f"margin_{r} AS (SELECT doc_id, y, n, {margin} FROM fit_rows JOIN fit_{r} USING (feature) GROUP BY doc_id, y, n)",
            f"error_{r} AS (SELECT doc_id, {residual} FROM margin_{r})",
            f"slope_{r} AS (SELECT feature, {', '.join(f'sum(c * r_{i})::BIGINT AS g_{i}' for i in k)} FROM fit_rows JOIN error_{r} USING (doc_id) GROUP BY feature)",
            f"fit_{r + 1} AS MATERIALIZED (SELECT feature, mass, {moved} FROM fit_{r} JOIN slope_{r} USING (feature))",
        ]
    verdict = " ".join(f"WHEN z_{i} = greatest({', '.join(f'z_{j}' for j in k)}) THEN {q(c)}" for i, c in enumerate(classes))
    return steps + [
        *word_rows("all_rows", "documents", "text", "doc_id"),
        f"all_margins AS (SELECT doc_id, count(*) AS n, {margin.replace('c * ', '')} FROM all_rows JOIN fit_{rounds} USING (feature) GROUP BY doc_id)",
        f"softmax_scored AS (SELECT doc_id, CASE {verdict} END AS label, round(1 / {whole}, 6) AS score FROM all_margins)",
    ]


LABELLED = [
    """labelled AS (SELECT doc_id, text, CASE quality WHEN 1 THEN 'wiki' WHEN 0 THEN 'cc' END AS quality,
       CASE toxic WHEN 1 THEN 'toxic' WHEN 0 THEN 'non-toxic' END AS toxic FROM documents JOIN labels USING (doc_id))"""
]


def trained(heads: tuple[C.Head, ...]) -> list[str]:
    keep = ", ".join(h.label for h in heads)
    return [*LABELLED, *word_rows("train_rows", "labelled", "text", keep), *model_ctes("model", "train_rows", heads)]


def judged_ctes(where: str = "TRUE") -> list[str]:
    """reason and masking counts of every document (optionally of chosen ones)."""
    return [
        *trained(HEADS),
        f"docs AS (SELECT doc_id, source, {strip('text')} AS stripped FROM documents WHERE {where})",
        f"counted AS (SELECT *, {n_words('stripped')} AS n_words FROM docs)",
        *measured("counted", "stripped"),
        f"ruled AS (SELECT doc_id, source, stripped, coalesce({length_reason('n_words')}, "
        f"CASE WHEN {FAILED_RULE} IS NOT NULL THEN 'gopher' END) AS rule FROM measured)",
        *masked_ctes("ruled", "stripped"),
        *word_rows("doc_rows", "ruled", "stripped", "doc_id"),
        *score_ctes("scored", "doc_rows", "model", HEADS),
        """judged AS (SELECT doc_id, source, CASE WHEN rule IS NOT NULL THEN rule WHEN quality_label = 'cc' THEN 'low_quality'
             WHEN toxic_label = 'toxic' THEN 'toxic' END AS reason, n_email, n_phone, n_ip, masked
             FROM masked_docs JOIN scored USING (doc_id))""",
    ]


REASONS = ("empty", "too_short", "too_long", "gopher", "low_quality", "nsfw", "toxic")
COUNTERS = ", ".join(
    [
        "count(*) AS total",
        "count(*) FILTER (reason IS NULL) AS kept",
        *[f"count(*) FILTER (reason = '{r}') AS rejected_{r}" for r in REASONS],
        "CAST(coalesce(sum(n_email) FILTER (reason IS NULL), 0) AS BIGINT) AS masked_emails",
        "CAST(coalesce(sum(n_phone) FILTER (reason IS NULL), 0) AS BIGINT) AS masked_phone_numbers",
        "CAST(coalesce(sum(n_ip) FILTER (reason IS NULL), 0) AS BIGINT) AS masked_ips",
        "count(*) FILTER (reason IS NULL AND n_email + n_phone + n_ip > 0) AS modified_pii_documents",
        "round(count(*) FILTER (reason IS NULL) / count(*), 6) AS keep_ratio",
    ]
)
LENGTH = "('empty', 'too_short', 'too_long')"

# -- language ----------------------------------------------------------------------------------------------

_FOLD = f"CAST('0x' || substr({order_key(q('fold'), 'doc_id')}, 1, 6) AS INT) % 5"
_U = f"{C.UNIT}::DOUBLE"


def _lang_sums(name: str, rows: str, keep: str = "doc_id") -> list[str]:
    """A row per text and language: the sum of its weights, known trigrams, all trigrams, and whether it is the likeliest."""
    return [
        f"{name}_n AS (SELECT {keep}, count(*) AS n_all FROM {rows} GROUP BY ALL)",
        f"{name}_s AS (SELECT {keep}, w.lang AS label, sum(w.w)::BIGINT AS s, count(*) AS n_known FROM {rows} r JOIN lang_w w ON w.feature = r.feature GROUP BY {keep}, w.lang)",
        f"""{name}_c AS MATERIALIZED (SELECT *, max(s) OVER (PARTITION BY doc_id) AS best, s / (n_known * {_U}) AS m,
            row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, label) = 1 AS first FROM {name}_s JOIN {name}_n USING ({keep}))""",
    ]


def _newton(rounds: int = 8) -> list[str]:
    steps = ["heat_0 AS (SELECT 2.0::DOUBLE AS t)"]
    for r in range(rounds):
        steps += [
            f"""slope_l{r} AS (SELECT doc_id, sum(e * m) / sum(e) AS x, sum(e * m * m) / sum(e) AS xx, max(m) FILTER (label = truth) AS own
                FROM (SELECT *, exp((m - max(m) OVER (PARTITION BY doc_id)) * t) AS e FROM heard_c, heat_{r}) GROUP BY doc_id)""",
            f"""heat_{r + 1} AS MATERIALIZED (SELECT CASE WHEN h > 0 THEN round(least(greatest(t - g / h, t / 4), 4 * t, 200.0), 6) ELSE t END AS t
                FROM heat_{r}, (SELECT sum(floor((x - own) * 1e9 + 0.5)::BIGINT)::DOUBLE AS g, sum(floor((xx - x * x) * 1e9 + 0.5)::BIGINT)::DOUBLE AS h FROM slope_l{r}))""",
        ]
    return [*steps, f"heat AS (SELECT t FROM heat_{rounds})"]


LANG_MODEL = [
    f"folded AS MATERIALIZED (SELECT doc_id, text, lang, {_FOLD} AS fold FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL)",
    "lang_train AS (SELECT lang, text FROM folded WHERE fold >= 2)",
    *trigram_rows("lang_rows", "lang_train", "text", "lang"),
    "lang_n AS MATERIALIZED (SELECT feature, lang, count(*) AS n FROM lang_rows GROUP BY ALL)",
    "lang_known AS (SELECT feature FROM lang_n GROUP BY feature HAVING sum(n) >= 2 OR feature = '')",
    """lang_cells AS MATERIALIZED (SELECT k.feature, c.lang, coalesce(n, 0) AS n FROM lang_known k CROSS JOIN (SELECT DISTINCT lang FROM lang_train) c
       LEFT JOIN lang_n USING (feature, lang))""",
    """lang_t AS (SELECT lang, sum(n) FILTER (feature <> '') AS t, count(*) FILTER (feature <> '') AS v, sum(n) FILTER (feature = '') AS d,
       sum(d) OVER () AS docs, count(*) OVER () AS k FROM lang_cells GROUP BY lang)""",
    f"""lang_w AS MATERIALIZED (SELECT feature, lang, n, CAST(round(CASE WHEN feature = '' THEN ln((n + 1) / (docs + k)) ELSE ln((n + 1) / (t + v)) END * {C.UNIT}) AS BIGINT) AS w,
       CAST(round(ln(1 / (t + v)) * {C.UNIT}) AS BIGINT) AS floor_w FROM lang_cells JOIN lang_t USING (lang))""",
    """lang_v AS MATERIALIZED (SELECT lang, any_value(floor_w) AS floor_w, greatest(sum(n * x * x)::DOUBLE / sum(n) / 1e6 - power(sum(n * x)::DOUBLE / sum(n) / 1e3, 2), 0) AS gram_var
       FROM (SELECT lang, n, floor_w, floor(w / 1000)::BIGINT AS x FROM lang_w WHERE feature <> '') GROUP BY lang)""",
    # calibration on held-out texts
    "heard AS (SELECT doc_id, text, lang AS truth FROM folded WHERE fold = 1 AND lang IN (SELECT lang FROM lang_train))",
    *trigram_rows("heard_rows", "heard", "text", "doc_id, truth"),
    *_lang_sums("heard", "heard_rows", "doc_id, truth"),
    *_newton(),
    f"""usual AS MATERIALIZED (SELECT label, sum(floor(x * 1e6 + 0.5)::BIGINT)::DOUBLE / count(*) / 1e6 AS mean,
        greatest(sum(floor(x * x * 1e6 + 0.5)::BIGINT)::DOUBLE / count(*) / 1e6 - mean * mean, 0) AS text_var FROM
        (SELECT label, (s + (n_all - n_known) * floor_w) / (n_all * {_U}) AS x FROM heard_c JOIN lang_v ON lang_v.lang = label WHERE first AND label = truth)
        GROUP BY label HAVING count(*) >= 5)""",
]


def lang_of(source: str, text: str = "text") -> list[str]:
    """Texts in other scripts do not occur in the tables; they would all be named by the script rule."""
    return [
        *trigram_rows("asked_rows", source, text, "doc_id"),
        *_lang_sums("asked", "asked_rows"),
        f"asked_p AS (SELECT doc_id, round(1 / sum(exp((s - best) * t / (n_known * {_U}))), 6) AS p FROM asked_c, heat GROUP BY doc_id)",
        f"""languages AS (SELECT doc_id, label, round(p * CASE WHEN z < 0 THEN exp(z) ELSE 1 END, 6) AS score FROM
            (SELECT doc_id, c.label, p, ((s + (n_all - n_known) * floor_w) / (n_all * {_U}) - mean) / sqrt(text_var + gram_var / n_all) + 3.0 AS z
             FROM asked_c c JOIN asked_p USING (doc_id) JOIN lang_v v ON v.lang = c.label LEFT JOIN usual u ON u.label = c.label WHERE first))""",
    ]


LANGUAGES = [*LANG_MODEL, *lang_of("documents")]

# -- duplicates --------------------------------------------------------------------------------------------

_N = MINHASH.ngrams
_GRAM = " || chr(31) || ".join(f"w[i + {k}]" for k in range(_N))
GRAMS = [
    f"norm AS (SELECT doc_id, {normal('text')} AS t FROM documents)",
    "wordlists AS (SELECT doc_id, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS w FROM norm)",
    f"all_grams AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(w) - {_N - 2}, 1)), lambda i: {_GRAM})) AS g FROM wordlists)",
    "grams AS (SELECT DISTINCT doc_id, g FROM all_grams)",
    "gram_sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id)",
]
_MINIMA = ", ".join(
    f"min(({a} * h + {b}) % {PRIME}) AS sig_{i}" for i, (a, b) in enumerate(minhash_family(MINHASH.num_hashes, MINHASH.seed))
)
SIGNATURES = [
    *GRAMS,
    "hashed AS (SELECT doc_id, CAST('0x' || substr(md5(g), 1, 8) AS BIGINT) AS h FROM grams)",
    f"signature AS (SELECT doc_id, {_MINIMA} FROM hashed GROUP BY doc_id)",
]
_R = MINHASH.rows_per_band
BANDS = [
    *SIGNATURES,
    "bands AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {b} AS band, concat_ws('-', {', '.join(f'sig_{i}' for i in range(b * _R, b * _R + _R))}) AS bucket FROM signature"
        for b in range(MINHASH.num_bands)
    )
    + ")",
]


def jaccard(pairs: str, name: str) -> list[str]:
    return [
        f"{name}_i AS (SELECT a, b, count(*) AS both_n FROM {pairs} JOIN grams x ON x.doc_id = a JOIN grams y ON y.doc_id = b AND y.g = x.g GROUP BY a, b)",
        f"{name} AS (SELECT a, b, both_n / (s.n + t.n - both_n) AS jaccard FROM {name}_i JOIN gram_sizes s ON s.doc_id = a JOIN gram_sizes t ON t.doc_id = b)",
    ]


#: Every pair of every bucket, as the definition has it: checks that the Spark plan loses none.
CLUSTERS = [
    *BANDS,
    "pairs AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y USING (band, bucket) WHERE x.doc_id < y.doc_id)",
    *jaccard("pairs", "similar_pairs"),
    f"edges AS (SELECT a, b FROM similar_pairs WHERE jaccard >= {MINHASH.threshold} UNION SELECT b, a FROM similar_pairs WHERE jaccard >= {MINHASH.threshold})",
    "reach(node, other) AS (SELECT a, b FROM edges UNION SELECT reach.node, edges.b FROM reach JOIN edges ON reach.other = edges.a)",
    "clusters AS (SELECT node AS doc_id, least(node, min(other)) AS cluster_id FROM reach GROUP BY node)",
]

# -- pages -------------------------------------------------------------------------------------------------


def extracted(x: str, drop: tuple[str, ...] = ()) -> str:
    """RE2 has no back-references: hidden elements are removed tag by tag. Only the entities of the tables are decoded."""
    for pattern, put in html.markup_steps(drop):
        if r"\1" in pattern:
            for tag in (*html.HIDDEN_TAGS, *drop):
                x = f"regexp_replace({x}, {q(rf'(?is)<{tag}' + chr(92) + r'b[^>]*>.*?</' + tag + chr(92) + 's*>')}, ' ', 'g')"
        else:
            x = f"regexp_replace({x}, {q(pattern)}, {q(put)}, 'g')"
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, {q(entity)}, {q(char)})"
    for pattern, put in html.BREAK_STEPS:
        x = f"regexp_replace({x}, {q(pattern)}, {q(put)}, 'g')"
    return f"replace(trim({x}, {q(' ' + chr(10))}), {q(chr(4))}, {q(html.ITEM)})"


_HOST = "lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)*([^/?#@:\\[\\]]+)', 1))"
CLEAN_URLS = [
    f"unescaped AS (SELECT DISTINCT replace({strip('url')}, '&amp;', '&') AS url FROM pages WHERE {strip('url')} <> '')",
    "clean AS (SELECT url FROM unescaped WHERE regexp_matches(url, '^(?i)https?://[^/?#]*[.][^/?#]*') "
    "AND contains(regexp_extract(url, '^(?i)https?://([^/?#]*)', 1), '[') = contains(regexp_extract(url, '^(?i)https?://([^/?#]*)', 1), ']'))",
]
#: Greedy run over the URL characters, trailing . : ? - trimmed.
_URL_RUN = r"\b(?:https?|telnet|gopher|file|wais|ftp):[\p{L}\p{N}_/#~:.?+=&%@!-]+"

# -- labelled set ------------------------------------------------------------------------------------------

_HARM = [*word_rows("train_rows", "labelled", "text", "toxic"), *model_ctes("model", "train_rows", (C.TOXIC,))]


def examples_of(flat_docs: str) -> list[str]:
    """``examples`` (doc_id, label, reason) of a query that gives doc_id, label and the flattened text."""
    return [
        *LABELLED,
        f"flat_docs AS ({flat_docs})",
        *measured("flat_docs", "flat"),
        *LANG_MODEL,
        *lang_of("flat_docs", "flat"),
        *_HARM,
        *word_rows("doc_rows", "flat_docs", "flat", "doc_id"),
        *score_ctes("harm", "doc_rows", "model", (C.TOXIC,)),
        f"""examples AS (SELECT doc_id, m.label, CASE WHEN flat = '' THEN 'empty' WHEN NOT (l.label = 'en' AND l.score >= 0.7) THEN 'non_english'
        WHEN m.label = 'wiki' AND {FAILED_RULE} IS NOT NULL THEN 'gopher_rejected'
        WHEN m.label = 'wiki' AND NOT (toxic_label <> 'toxic' AND toxic_score >= 0.7) THEN 'toxic_rejected' END AS reason
        FROM measured m JOIN languages l USING (doc_id) JOIN harm USING (doc_id))""",
        "usable AS (SELECT doc_id, label FROM examples WHERE reason IS NULL)",
    ]


EXAMPLES = examples_of(f"SELECT doc_id, quality AS label, {flat('text')} AS flat FROM labelled")
_FAILURE = """CASE page_id % 20 WHEN 0 THEN 'http_404' WHEN 1 THEN 'http_500' WHEN 2 THEN 'no_http_headers' WHEN 3 THEN 'non_html' WHEN 4 THEN 'errors'
    WHEN 5 THEN 'empty' END"""
_PAGE_LABEL = "CASE WHEN page_id % 2 = 0 THEN 'wiki' ELSE 'cc' END"
#: Pages as responses: those that fail before their text is looked at, then the examples of the others.
RESPONSES = [
    *examples_of(f"SELECT page_id AS doc_id, {_PAGE_LABEL} AS label, {flat(extracted('html'))} AS flat FROM pages WHERE {_FAILURE} IS NULL"),
    f"all_responses AS (SELECT * FROM examples UNION ALL SELECT page_id, {_PAGE_LABEL}, {_FAILURE} FROM pages WHERE {_FAILURE} IS NOT NULL)",
]


def balanced(source: str) -> list[str]:
    key = order_key("doc_id")
    return [
        f"ranked AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {key}, doc_id) AS r FROM {source} WHERE label IN ('wiki', 'cc'))",
        f"""smallest AS (SELECT least(3000, count(*) FILTER (label = 'wiki'), count(*) FILTER (label = 'cc')) AS n FROM {source})""",
        "balanced AS (SELECT doc_id, label FROM ranked, smallest WHERE r <= n)",
        f"shuffled AS (SELECT doc_id, label, row_number() OVER (ORDER BY {order_key(q('split'), 'doc_id')}, doc_id) AS r, count(*) OVER () AS n FROM balanced)",
        "split_set AS (SELECT doc_id, label, CASE WHEN r <= floor(0.9::DOUBLE * n) THEN 'train' ELSE 'valid' END AS split FROM shuffled)",
    ]


BUILT = [*EXAMPLES, *balanced("usable")]

# -- tokens ------------------------------------------------------------------------------------------------

PIECES = [
    f"pieces AS (SELECT doc_id, regexp_extract_all(text, {q(K.PRETOKEN)}) AS p FROM documents)",
    "piece_rows AS (SELECT doc_id, unnest(p) AS token, generate_subscripts(p, 1) AS pos FROM pieces)",
]
TOKENS = [
    *PIECES,
    f"vocab_top AS (SELECT token, count(*) AS n FROM piece_rows GROUP BY token ORDER BY n DESC, token LIMIT {K.MAX_VOCABULARY})",
    "vocab AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) + 255 AS id FROM vocab_top)",
    """spelled AS (SELECT token, if(id IS NOT NULL, [id], list_transform(range(1, strlen(token) * 2, 2),
       lambda i: CAST('0x' || substr(hex(encode(token)), i, 2) AS BIGINT))) AS ids
       FROM (SELECT DISTINCT token FROM piece_rows) LEFT JOIN vocab USING (token))""",
    "ids AS (SELECT doc_id, flatten(list(ids ORDER BY pos)) AS l FROM piece_rows JOIN spelled USING (token) GROUP BY doc_id)",
    f"tokens AS (SELECT doc_id, list_append(coalesce(l, []), {K.EOS_ID}) AS tokens FROM documents LEFT JOIN ids USING (doc_id))",
]

SAMPLE_POOL = f"pool AS (SELECT * FROM documents ORDER BY doc_id LIMIT 500), usable_pool AS (SELECT * FROM pool WHERE {strip('text')} <> '')"
SAMPLED_POOL = [
    SAMPLE_POOL,
    f"sampled AS (SELECT *, row_number() OVER (ORDER BY {order_key('doc_id', seed=42)}, doc_id) AS rank FROM usable_pool QUALIFY rank <= 20)",
]


def _toxic_scores(source: str) -> list[str]:
    return [*trained((C.TOXIC,)), *word_rows("doc_rows", source, "text", "doc_id"), *score_ctes("scored", "doc_rows", "model", (C.TOXIC,))]


_STAGES = (("length", LENGTH), ("rules", "('gopher')"), ("quality", "('low_quality')"), ("nsfw", "('nsfw')"), ("toxic", "('toxic')"))
_FUNNEL = " UNION ALL ".join(
    f"SELECT {i} AS stage_no, '{name}' AS stage, count(*) FILTER (reason IN {reasons}) AS removed FROM judged"
    for i, (name, reasons) in enumerate(_STAGES, 1)
)

_COUNTED, _SEEN = "SELECT label, coalesce(reason, 'kept') AS reason, count(*) AS n", "UNION ALL SELECT label, 'seen', count(*)"

ORACLE: dict[str, str] = {
    "word_count": f"SELECT doc_id, {n_words('text')} AS n_words FROM documents",
    "ws_normalize": f"SELECT doc_id, {flat('text')} AS text_norm FROM documents",
    "normalize_text": f"SELECT doc_id, {normal('text')} AS text_norm FROM documents",
    "length_filter": f"SELECT doc_id, n_words, {length_reason('n_words')} AS reason FROM (SELECT doc_id, {n_words('text')} AS n_words FROM documents)",
    "mask_emails": _single_mask(mask_email, pii.EMAIL_MASK),
    "mask_phones": _single_mask(mask_phone, pii.PHONE_MASK),
    "mask_ips": _single_mask(mask_ip, pii.IP_MASK),
    "pii_mask_all": with_(
        [f"docs AS (SELECT doc_id, {strip('text')} AS stripped FROM documents)", *masked_ctes("docs", "stripped")],
        "SELECT doc_id, masked, n_email, n_phone, n_ip FROM masked_docs",
    ),
    "pii_hits": with_(
        [f"docs AS (SELECT doc_id, {strip('text')} AS stripped FROM documents)", *masked_ctes("docs", "stripped")],
        "SELECT doc_id, masked, n_email, n_phone, n_ip FROM masked_docs WHERE n_email + n_phone + n_ip > 0 ORDER BY doc_id LIMIT 20",
    ),
    "quality_rules": with_(
        measured("documents", "text"),
        f"SELECT doc_id, n_tokens, round(mean_len, 6) AS mean_len, round(ellipsis_share, 6) AS ellipsis_share, round(alpha_share, 6) AS alpha_share, {FAILED_RULE} AS failed_rule FROM measured",
    ),
    "quality_filter": with_(measured("documents", "text"), f"SELECT doc_id, {FAILED_RULE} IS NULL AS passed FROM measured"),
    "rejection_reason": with_(judged_ctes(), "SELECT doc_id, reason FROM judged"),
    "filter_report": with_(judged_ctes(), f"SELECT {COUNTERS} FROM judged"),
    "filter_report_by_source": with_(
        judged_ctes(), f"SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source, {COUNTERS} FROM judged GROUP BY ROLLUP (source)"
    ),
    "incremental_report": with_(
        judged_ctes(), f"SELECT CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source, {COUNTERS} FROM judged GROUP BY ROLLUP (source)"
    ),
    "filter_funnel": with_(
        [*judged_ctes(), f"funnel AS ({_FUNNEL})", "rejected AS (SELECT count(*) AS total, count(reason) AS n FROM judged)"],
        "SELECT stage_no, stage, removed, CAST(total - sum(removed) OVER (ORDER BY stage_no) AS BIGINT) AS remaining, "
        "round(CASE WHEN n > 0 THEN removed / n ELSE 0 END, 6) AS share FROM funnel, rejected",
    ),
    "baseline_vs_final": with_(
        judged_ctes(),
        f"""SELECT 'baseline' AS version, count(*) AS total, count(*) FILTER (reason IS NULL OR reason NOT IN {LENGTH}) AS kept,
            round(count(*) FILTER (reason IS NULL OR reason NOT IN {LENGTH}) / count(*), 6) AS keep_ratio FROM judged
            UNION ALL SELECT 'final', count(*), count(*) FILTER (reason IS NULL), round(count(*) FILTER (reason IS NULL) / count(*), 6) FROM judged""",
    ),
    "curate_documents": with_(
        judged_ctes(), f"SELECT doc_id, source, {n_words('masked')} AS word_count, masked AS text FROM judged WHERE reason IS NULL"
    ),
    "exact_line_dedup": with_(
        [
            "parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)",
            "rows_ AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos, len(p) AS n FROM parts)",
            "lines AS (SELECT doc_id, pos, CASE WHEN pos < n THEN piece || chr(10) ELSE piece END AS line FROM rows_ WHERE pos < n OR piece <> '')",
            "single AS (SELECT line FROM lines GROUP BY line HAVING count(*) = 1)",
            "kept AS (SELECT doc_id, string_agg(line, '' ORDER BY pos) AS t FROM lines JOIN single USING (line) GROUP BY doc_id)",
        ],
        "SELECT d.doc_id, coalesce(t, '') AS text FROM documents d LEFT JOIN kept USING (doc_id)",
    ),
    "exact_doc_dedup": f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {flat('lower(nfc_normalize(text))')}",
    "exact_dedup_report": f"""SELECT sum(n)::BIGINT AS documents, count(*) AS kept, (sum(n) - count(*))::BIGINT AS removed
        FROM (SELECT count(*) AS n FROM documents GROUP BY {flat('lower(nfc_normalize(text))')})""",
    "ngram_counts": with_(GRAMS, "SELECT doc_id, coalesce(n, 0) AS n_grams FROM documents LEFT JOIN gram_sizes USING (doc_id)"),
    "minhash_signature": with_(SIGNATURES, "SELECT * FROM signature"),
    "lsh_candidates": with_(
        BANDS, "SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y USING (band, bucket) WHERE x.doc_id < y.doc_id"
    ),
    "lsh_buckets": with_(
        BANDS, "SELECT doc_id, band, min(doc_id) OVER w AS leader, count(*) OVER w AS n FROM bands WINDOW w AS (PARTITION BY band, bucket) QUALIFY n > 1"
    ),
    "jaccard_pairs": with_(
        [*CLUSTERS, "same AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(string_agg(g, chr(30) ORDER BY g))) AS rep FROM grams GROUP BY doc_id)"],
        f"""SELECT a, b, round(jaccard, 6) AS jaccard FROM similar_pairs JOIN same x ON x.doc_id = a AND x.rep = a
            JOIN same y ON y.doc_id = b AND y.rep = b WHERE jaccard >= {MINHASH.threshold}
            UNION ALL SELECT rep, doc_id, 1.0 FROM same WHERE rep <> doc_id""",
    ),
    "dup_clusters": with_(CLUSTERS, "SELECT doc_id, cluster_id FROM clusters"),
    "fuzzy_dedup": with_(CLUSTERS, "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM clusters WHERE doc_id <> cluster_id)"),
    "html_extract": f"SELECT page_id, {extracted('html')} AS text FROM pages",
    "extract_compare": f"""SELECT page_id, len(f) AS n_full, len(b) AS n_no_nav,
        len(list_distinct(list_intersect(string_split(f, chr(10)), string_split(b, chr(10))))) AS shared_lines
        FROM (SELECT page_id, {extracted('html')} AS f, {extracted('html', ('nav',))} AS b FROM pages)""",
    "zip_mismatches": """WITH a AS (SELECT page_id AS k, row_number() OVER (ORDER BY page_id) - 1 AS position FROM pages),
        b AS (SELECT page_id AS k, row_number() OVER (ORDER BY page_id) - 1 AS position FROM pages WHERE NOT contains(url, '//m.'))
        SELECT position, a.k AS left_key, b.k AS right_key,
          CASE WHEN a.k IS NULL THEN NULL WHEN a.k IN (SELECT k FROM b) THEN 'moved' ELSE 'missing' END AS left_status,
          CASE WHEN b.k IS NULL THEN NULL WHEN b.k IN (SELECT k FROM a) THEN 'moved' ELSE 'missing' END AS right_status
        FROM a FULL JOIN b USING (position) WHERE a.k IS DISTINCT FROM b.k""",
    "url_domain": f"""SELECT page_id, regexp_extract(rtrim({_HOST}, '.'), '([^.]+[.](?:com|net|org))$', 1) AS domain FROM pages""",
    # what each ending gives, written out: the part of the host that is its registered domain
    "url_domain_rules": f"""SELECT page_id, ending, CASE WHEN ending = 'ck' AND h = 'www' THEN 'www.ck' WHEN tail = 'none' THEN '' WHEN tail = 'own' THEN ending WHEN tail = 'one' THEN h || '.' || ending
        ELSE 'www.' || h || '.' || ending END AS domain FROM (SELECT page_id, split_part({_HOST}, '.', 1) AS h FROM pages),
        (VALUES ('co.ke', 'one'), ('com.do', 'one'), ('bar.ck', 'one'), ('www.ck', 'own'), ('ck', 'two'), ('tokyo.jp', 'one'),
         ('city.kobe.jp', 'own'), ('x.kobe.jp', 'one'), ('co.uk', 'one'), ('nosuchsuffix', 'none'), ('com', 'one'), ('es', 'one'))
        AS endings(ending, tail)""",
    "valid_urls": with_(CLEAN_URLS, "SELECT url FROM clean"),
    "url_extract": f"""SELECT DISTINCT rtrim(u, '.:?-') AS url FROM (SELECT unnest(regexp_extract_all(
        regexp_extract(replace(html, chr(10), ' ') || ' &lt;ref&gt;' || url || '. &lt;/ref&gt; ' || url, '&lt;ref&gt(.*)&lt;/ref&gt;'),
        {q(_URL_RUN)})) AS u FROM pages)""",
    "url_sample": with_(CLEAN_URLS, f"SELECT url, row_number() OVER (ORDER BY {order_key('url')}, url) AS rank FROM clean QUALIFY rank <= 10000"),
    "manifest_chunks": f"""SELECT CAST((r - 1) // 4 AS INTEGER) AS chunk, count(*) AS n_files, arg_min(url, r) AS first_url
        FROM (SELECT url, row_number() OVER (ORDER BY {order_key('url')}, url) AS r FROM pages) WHERE r <= 40 GROUP BY 1""",
    "lang_id": with_(LANGUAGES, "SELECT doc_id, label, score FROM languages"),
    "english_filter": with_(LANGUAGES, "SELECT doc_id FROM languages WHERE label = 'en' AND score >= 0.7"),
    "english_text_share": with_(
        LANGUAGES,
        """SELECT sum(len(text))::BIGINT AS total_chars, coalesce(sum(len(text)) FILTER (label = 'en' AND score >= 0.7), 0)::BIGINT AS kept_chars,
           round(100 * coalesce(sum(len(text)) FILTER (label = 'en' AND score >= 0.7), 0) / sum(len(text)), 6) AS kept_percent
           FROM documents JOIN languages USING (doc_id)""",
    ),
    "langid_confusion": with_(LANGUAGES, f"SELECT lang, label, count(*) AS n FROM languages JOIN documents USING (doc_id) WHERE {_FOLD} = 0 GROUP BY lang, label"),
    "threshold_curve": with_(
        [*LANGUAGES, f"judged_langs AS (SELECT doc_id, label, score, lang FROM languages JOIN documents USING (doc_id) WHERE {_FOLD} = 0)"],
        """SELECT least(floor(score * 20), 19)::INTEGER AS bucket, count(*) FILTER (label = lang) AS n_right, count(*) FILTER (label <> lang) AS n_wrong,
           round(least(floor(score * 20), 19) / 20, 6) AS from_score FROM judged_langs GROUP BY 1, 4""",
    ),
    "langid_review_sample": with_(
        [*SAMPLED_POOL, *LANG_MODEL, *lang_of("sampled")],
        "SELECT doc_id, rank, label, score, substr(text, 1, 800) AS excerpt FROM sampled JOIN languages USING (doc_id)",
    ),
    "train_quality_nb": with_(
        trained((C.QUALITY,)),
        "SELECT feature, 'cc' AS label, n_quality_0 AS n FROM model UNION ALL SELECT feature, 'wiki', n_quality_1 FROM model",
    ),
    "quality_score": with_(
        [*trained((C.QUALITY,)), *word_rows("doc_rows", "documents", "text", "doc_id"), *score_ctes("scored", "doc_rows", "model", (C.QUALITY,))],
        "SELECT doc_id, quality_label AS label, quality_score AS score FROM scored",
    ),
    "train_quality_lr": with_([*LABELLED, *softmax_ctes(C.QUALITY.classes, "quality")], "SELECT doc_id, label, score FROM softmax_scored"),
    "toxicity_score": with_(_toxic_scores("documents"), "SELECT doc_id, toxic_label AS label, toxic_score AS score FROM scored"),
    "confident_clean": with_(
        _toxic_scores("documents"),
        "SELECT doc_id, toxic_label AS label, toxic_score AS score FROM scored WHERE toxic_label <> 'toxic' AND toxic_score >= 0.7",
    ),
    "build_stats": with_(EXAMPLES, f"{_COUNTED} FROM examples GROUP BY 1, 2 {_SEEN} FROM examples GROUP BY 1"),
    "response_stats": with_(RESPONSES, f"{_COUNTED} FROM all_responses GROUP BY 1, 2 {_SEEN} FROM all_responses GROUP BY 1"),
    "response_quarantine": f"""SELECT page_id AS doc_id, {_PAGE_LABEL} AS label, coalesce({_FAILURE}, 'empty') AS reason, page_id % 20 = 4 AS failed
        FROM pages WHERE {_FAILURE} IS NOT NULL OR {flat(extracted('html'))} = ''""",
    "build_set_from_responses": with_([*RESPONSES, *balanced("usable")], "SELECT doc_id, label, split FROM split_set"),
    "balanced_set": with_(BUILT, "SELECT doc_id, label FROM balanced"),
    "train_valid_split": with_([*LABELLED, "raw AS (SELECT doc_id, CASE quality WHEN 1 THEN 'wiki' ELSE 'cc' END AS label FROM labels)", *balanced("raw")], "SELECT doc_id, label, split FROM split_set"),
    "build_quality_set": with_(BUILT, "SELECT doc_id, label, split FROM split_set"),
    "labelled_lines": with_(BUILT, f"SELECT doc_id, split, '__label__' || label || ' ' || {flat('text')} AS line FROM split_set JOIN documents USING (doc_id)"),
    "quality_eval": with_(
        [
            *BUILT,
            f"set_docs AS (SELECT doc_id, label AS quality, split, {flat('text')} AS flat FROM split_set JOIN documents USING (doc_id))",
            "set_train AS (SELECT * FROM set_docs WHERE split = 'train')",
            "set_valid AS (SELECT * FROM set_docs WHERE split = 'valid')",
            *word_rows("set_rows", "set_train", "flat", "quality"),
            *model_ctes("set_model", "set_rows", (C.QUALITY,)),
            *word_rows("valid_rows", "set_valid", "flat", "doc_id"),
            *score_ctes("set_scored", "valid_rows", "set_model", (C.QUALITY,)),
        ],
        """SELECT count(*) AS n, round(count(*) FILTER (quality = quality_label) / count(*), 6) AS precision_at_1,
           round(count(*) FILTER (quality = quality_label) / count(*), 6) AS recall_at_1 FROM set_valid JOIN set_scored USING (doc_id)""",
    ),
    "sample_kept": with_(
        judged_ctes(), f"SELECT doc_id, row_number() OVER (ORDER BY {order_key('doc_id')}, doc_id) AS rank FROM judged WHERE reason IS NULL QUALIFY rank <= 5"
    ),
    "sample_rejected": with_(
        judged_ctes(f"doc_id IN (SELECT doc_id FROM documents ORDER BY {order_key('doc_id')}, doc_id LIMIT 100)"),
        f"SELECT doc_id, reason, row_number() OVER (ORDER BY {order_key('doc_id', seed=SEED + 1)}, doc_id) AS rank FROM judged WHERE reason IS NOT NULL QUALIFY rank <= 5",
    ),
    "quality_review_sample": with_([*SAMPLED_POOL, *measured("sampled", "text")], f"SELECT doc_id, rank, {FAILED_RULE} IS NULL AS passed FROM measured"),
    "harm_review_sample": with_(
        [*SAMPLED_POOL, *_toxic_scores("sampled")],
        "SELECT doc_id, rank, toxic_label AS verdict, toxic_score AS score FROM sampled JOIN scored USING (doc_id)",
    ),
    "tokenize_docs": with_(TOKENS, "SELECT doc_id, len(tokens) AS n_tokens, md5(array_to_string(tokens, ' ')) AS token_hash FROM tokens"),
    "detokenize_docs": "SELECT doc_id, text FROM documents",
    "token_offsets": with_(
        TOKENS, "SELECT doc_id, CAST(coalesce(sum(len(tokens)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset FROM tokens"
    ),
    "token_report": with_(
        TOKENS,
        f"SELECT count(*) AS documents, sum(len(tokens))::BIGINT AS tokens, (2 * sum(len(tokens)))::BIGINT AS output_bytes, 'uint16' AS dtype, {K.EOS_ID} AS eos_token_id FROM tokens",
    ),
    "pack_sequences": with_(
        [
            *TOKENS,
            "flat_ids AS (SELECT doc_id, unnest(tokens) AS id, generate_subscripts(tokens, 1) AS pos FROM tokens)",
            "stream AS (SELECT id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS place FROM flat_ids)",
            f"xs AS (SELECT place // {K.WINDOW} AS seq_id, list(id ORDER BY place) AS x FROM stream WHERE place + 1 < (SELECT count(*) FROM stream) GROUP BY 1)",
            f"ys AS (SELECT (place - 1) // {K.WINDOW} AS seq_id, list(id ORDER BY place) AS y FROM stream WHERE place > 0 GROUP BY 1)",
        ],
        "SELECT seq_id, x, y FROM xs JOIN ys USING (seq_id)",
    ),
}
