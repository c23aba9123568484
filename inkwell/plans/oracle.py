"""DuckDB spellings of the views and column expressions, for the SQL oracle.

They mirror ``inkwell.sources.tables`` and ``inkwell.functions`` one to one; the
regular expressions come from ``inkwell.constants`` so both engines read the same
pattern text.
"""

from __future__ import annotations

from inkwell import constants as C


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def sql_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


# --- views -----------------------------------------------------------------------

PAGE_OF_DOC = """page_of_doc AS (
  SELECT d.doc_id, p.url
  FROM documents d
  LEFT JOIN pages p ON p.page_id = d.doc_id % greatest((SELECT count(*) FROM pages), 1)
)"""

ARTICLES = PAGE_OF_DOC + """,
articles AS (
  SELECT d.doc_id,
         NULL::VARCHAR AS source_id, d.source AS source_name,
         '' AS author,
         split_part(d.text, chr(10), 1) AS title,
         split_part(d.text, chr(10), 1) AS description,
         pd.url, '' AS urlToImage, '' AS publishedAt,
         d.text AS content, d.lang AS language
  FROM documents d LEFT JOIN page_of_doc pd USING (doc_id)
)"""

FEED_ROWS = PAGE_OF_DOC + """,
feed_rows AS (
  SELECT d.doc_id,
         strftime(e.ts, '%Y%m%d%H%M') AS publish_time,
         d.source AS feed_code,
         pd.url AS source_url,
         split_part(d.text, chr(10), 1) AS headline_text
  FROM documents d
  JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN page_of_doc pd USING (doc_id)
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- text expressions --------------------------------------------------------------

def rx_replace(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def strip_tags(x: str) -> str:
    return rx_replace(x, C.TAG_RE, " ")


def strip_urls(x: str) -> str:
    return rx_replace(x, C.URL_RE, " ")


def strip_symbols(x: str) -> str:
    return rx_replace(x, C.SYMBOL_RE, " ")


def collapse_ws(x: str) -> str:
    return f"trim({rx_replace(x, C.WS_RUN_RE, ' ')})"


def dediac(x: str) -> str:
    return rx_replace(x, C.ARABIC_DIACRITICS_RE, "")


def clean_text(x: str) -> str:
    return collapse_ws(strip_symbols(strip_urls(strip_tags(f"coalesce({x}, '')"))))


def tokenize(x: str) -> str:
    """Whole-token contraction split (each token padded by its own blanks)."""
    s = f"(' ' || replace({x}, ' ', '  ') || ' ')"
    for a, b in C.CONTRACTIONS:
        s = f"regexp_replace({s}, {q(f'(?i) ({a})({b}) ')}, ' \\1 \\2 ', 'g')"
    return f"list_filter(string_split({s}, ' '), lambda t: t <> '')"


def remove_stopwords(tokens: str, lang: str | None = None) -> str:
    en = sql_list(C.ENGLISH_STOPWORDS)
    if lang is None:
        stops = en
    else:
        stops = f"(CASE WHEN {lang} = 'ar' THEN {sql_list(C.ARABIC_STOPWORDS)} ELSE {en} END)"
    return f"list_filter({tokens}, lambda t: NOT list_contains({stops}, lower(t)))"


def join_tokens(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def cleaned_text(x: str, lang: str | None = None) -> str:
    return join_tokens(remove_stopwords(tokenize(clean_text(x)), lang))


def first_non_empty(*xs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"


def terms(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), {q(C.TERM_RE)})"


def ngrams(t: str) -> str:
    return (f"list_concat({t}, list_transform(range(1, len({t})), "
            f"lambda i: {t}[i] || ' ' || {t}[i + 1]))")


def non_blank(x: str) -> str:
    return f"regexp_matches({x}, {q(C.NON_BLANK_RE)})"


# --- naive Bayes (multinomial, Laplace), dense over labels ------------------------------

def nb_fit(name: str, train: str, alpha: float = 1.0) -> str:
    """CTEs ``{name}_priors(label, log_prior)`` and ``{name}_cond(feature, label, log_p)``.

    ``train`` is a relation with columns (label, feature) - one row per feature
    occurrence - and ``{name}_docs(label)`` must list one row per training document.
    """
    return f"""{name}_counts AS (SELECT label, feature, count(*) AS c FROM {train} GROUP BY label, feature),
{name}_n AS (SELECT label, count(*) AS n FROM {name}_docs GROUP BY label),
{name}_priors AS (SELECT label, ln(n) - ln(sum(n) OVER ()) AS log_prior FROM {name}_n),
{name}_totals AS (SELECT label, sum(c) AS t FROM {name}_counts GROUP BY label),
{name}_v AS (SELECT count(DISTINCT feature) AS v FROM {name}_counts),
{name}_cond AS (
  SELECT f.feature, p.label,
         ln(coalesce(c.c, 0) + {alpha}) - ln(t.t + {alpha} * v.v) AS log_p
  FROM (SELECT DISTINCT feature FROM {name}_counts) f
  CROSS JOIN {name}_priors p
  LEFT JOIN {name}_counts c ON c.feature = f.feature AND c.label = p.label
  JOIN {name}_totals t ON t.label = p.label
  CROSS JOIN {name}_v v)"""


def nb_predict(name: str, model: str, feats: str) -> str:
    """CTE ``{name}(id, label, prob)``; ``feats`` has (id, feature) per occurrence."""
    return f"""{name}_cnt AS (SELECT id, feature, count(*) AS n FROM {feats} GROUP BY id, feature),
{name}_ll AS (
  SELECT q.id, m.label, sum(q.n * m.log_p) AS ll
  FROM {name}_cnt q JOIN {model}_cond m USING (feature) GROUP BY q.id, m.label),
{name}_sc AS (SELECT id, label, ll + log_prior AS score FROM {name}_ll JOIN {model}_priors USING (label)),
{name}_mx AS (SELECT *, max(score) OVER (PARTITION BY id) AS m,
                    row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rk FROM {name}_sc),
{name} AS (
  SELECT id, max(CASE WHEN rk = 1 THEN label END) AS label, 1.0 / sum(exp(score - m)) AS prob
  FROM {name}_mx GROUP BY id)"""


def lang_norm(x: str) -> str:
    return f"(' ' || trim(lower({rx_replace(f'coalesce({x}, {q(chr(39)*0)})', C.WS_RUN_RE, ' ')})) || ' ')"


def trigram_rows(rel: str, key: str, text: str) -> str:
    """SELECT key, feature over every character trigram of the normalized text."""
    s = lang_norm(text)
    return (f"SELECT {key}, unnest(list_transform(range(1, length(s) - 1), lambda i: substring(s, i, 3)))"
            f" AS feature FROM (SELECT {key}, {s} AS s FROM {rel})")


NOT_ARABIC_LETTER_RE = r"[^\x{0621}-\x{064A}]"
NOT_LETTER_RE = r"[^\p{L}]"


def is_arabic_script(x: str) -> str:
    t = f"coalesce({x}, '')"
    return (f"(length({rx_replace(t, NOT_LETTER_RE, '')}) > 0 AND "
            f"length({rx_replace(t, NOT_ARABIC_LETTER_RE, '')}) * 2 > length({rx_replace(t, NOT_LETTER_RE, '')}))")


LANGID_MODEL = f"""lid_docs AS (SELECT lang AS label FROM documents WHERE lang IS NOT NULL AND lang <> ''),
lid_train AS (SELECT lang AS label, feature FROM ({trigram_rows(
    "(SELECT * FROM documents WHERE lang IS NOT NULL AND lang <> '')", 'lang', 'text')})),
""" + nb_fit("lid", "lid_train")


def langid_detect(name: str, rel: str, id_col: str, text_col: str) -> str:
    """CTE ``{name}({id_col}, language, language_prob)`` over relation ``rel`` (needs LANGID_MODEL)."""
    feats = f"(SELECT {id_col} AS id, feature FROM ({trigram_rows(rel, id_col, text_col)}))"
    return nb_predict(f"{name}_nb", "lid", feats) + f""",
{name} AS (
  SELECT r.{id_col},
         CASE WHEN r.{text_col} IS NULL OR r.{text_col} = '' THEN ''
              WHEN {is_arabic_script('r.' + text_col)} THEN 'ar'
              ELSE coalesce(p.label, '') END AS language,
         CASE WHEN r.{text_col} IS NULL OR r.{text_col} = '' THEN 0.0
              WHEN {is_arabic_script('r.' + text_col)} THEN 1.0
              ELSE coalesce(p.prob, 0.0) END AS language_prob
  FROM {rel} r LEFT JOIN {name}_nb p ON p.id = r.{id_col})"""


# --- HTML, URL and time fields ------------------------------------------------------------

def _html():
    from inkwell.functions import html as H
    return H


def _fields():
    from inkwell.functions import fields as FF
    return FF


def unescape(x: str) -> str:
    names = _html().ENTITIES
    named = f"map({sql_list(names)}, {sql_list(names.values())})"
    code = ("TRY_CAST(CASE WHEN r[3] IN ('x', 'X') THEN '0x' || rtrim(r[4:], ';') ELSE rtrim(r[3:], ';') END AS BIGINT)")
    ok = f"({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111)"
    one = (f"CASE WHEN r LIKE '&#_%' THEN CASE WHEN {ok} THEN chr(CAST({code} AS INTEGER)) ELSE chr(65533) END "
           f"WHEN r LIKE '&_%' THEN coalesce({named}[r], r) ELSE r END")
    parts = f"regexp_extract_all({x}, '&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&')"
    return f"CASE WHEN {x} LIKE '%&%' THEN array_to_string(list_transform({parts}, lambda r: {one}), '') ELSE {x} END"


def visible(h: str) -> str:
    x = f"coalesce({h}, '')"
    for pat in _html().INVISIBLE_RE:
        x = rx_replace(x, pat, _html().SEPARATOR)
    return x


def text_of(x: str) -> str:
    H = _html()
    pieces = f"string_split_regex({x}, {q(H.TAG_SPLIT_RE)})"
    stripped = f"list_transform({pieces}, lambda p: {rx_replace(unescape('p'), H.EDGE_WS_RE, '')})"
    return f"array_to_string(list_filter({stripped}, lambda p: p <> ''), ' ')"


def has_article(h: str) -> str:
    return f"regexp_matches({visible(h)}, {q(_html().HAS_ARTICLE_RE)})"


def article_text(h: str) -> str:
    """Marks instead of tags, then the first place where as many articles were closed as opened."""
    opening, closing = q(r"(?i)<article([\s/][^>]*)?>"), q(r"(?i)</article\s*>")
    tags = f"regexp_replace({visible(h)}, {opening}, chr(1) || 'o\\1' || chr(2), 'g')"
    x = f"regexp_replace({tags}, {closing}, chr(1) || 'c' || chr(2), 'g')"
    pieces = f"string_split({x}, chr(1))"
    # a piece is its tag, chr(2) and the text after it; the text before the first tag is no piece
    kind = lambda p: (f"CASE WHEN starts_with({p}, 'c') THEN -1 WHEN ends_with(split_part({p}, chr(2), 1), '/') THEN 0 "  # noqa: E731
                      f"ELSE 1 END")
    opened = f"list_position(list_transform(ap, lambda v: starts_with(v, 'o')), true)"
    inner = f"ap[{opened}:]"
    depth = f"list_transform(range(1, len(aq) + 1), lambda k: list_sum(list_transform(aq[1:k], lambda w: {kind('w')})))"
    cut = f"coalesce(list_position({depth}, 0) - 1, len(aq))"
    body = f"array_to_string(list_transform(aq[1:{cut}], lambda z: substr(z, strpos(z, chr(2)) + 1)), '<>')"
    chosen = f"list_transform([{inner}], lambda aq: {text_of(body)})[1]"
    return f"coalesce(list_transform([{pieces}[2:]], lambda ap: CASE WHEN {opened} IS NULL THEN '' ELSE {chosen} END)[1], '')"


def paragraph_text(h: str) -> str:
    H = _html()
    parts = f"string_split_regex({visible(h)}, {q(H.PARAGRAPH_OPEN_RE)})[2:]"
    cut = f"regexp_replace(p, {q('(?is)(?:' + H.PARAGRAPH_END_RE + ').*')}, '')"
    return f"array_to_string(list_transform({parts}, lambda p: {_text_of_var(cut)}), ' ')"


def _text_of_var(x: str) -> str:
    # same as text_of, with its own lambda variable name (no shadowing of 'p')
    H = _html()
    pieces = f"string_split_regex({x}, {q(H.TAG_SPLIT_RE)})"
    un = unescape("pc")
    stripped = f"list_transform({pieces}, lambda pc: {rx_replace(un, H.EDGE_WS_RE, '')})"
    return f"array_to_string(list_filter({stripped}, lambda pc: pc <> ''), ' ')"


def main_text(h: str) -> str:
    return f"CASE WHEN {has_article(h)} THEN {article_text(h)} ELSE {paragraph_text(h)} END"


def main_image(h: str) -> str:
    H = _html()
    meta = f"regexp_extract({visible(h)}, {q(H.META_IMAGE_RE)}, 0)"
    val = (f"CASE WHEN regexp_matches({meta}, {q(H.CONTENT_DQ_RE)}) THEN regexp_extract({meta}, {q(H.CONTENT_DQ_RE)}, 1)"
           f" WHEN regexp_matches({meta}, {q(H.CONTENT_SQ_RE)}) THEN regexp_extract({meta}, {q(H.CONTENT_SQ_RE)}, 1)"
           f" ELSE '' END")
    return unescape(val)


def source_host(u: str) -> str:
    FF = _fields()
    x = f"regexp_replace(regexp_replace({u}, {q(FF.URL_UNSAFE_RE)}, '', 'g'), {q(FF.URL_LEADING_RE)}, '')"
    h = f"regexp_extract({x}, {q(FF.NETLOC_RE)}, 1)"
    return (f"CASE WHEN (instr({h}, '[') > 0) <> (instr({h}, ']') > 0) THEN NULL "
            f"ELSE replace({h}, 'www.', '') END")


def publish_time(ts: str) -> str:
    FF = _fields()
    return (f"CASE WHEN regexp_matches({ts}, {q(FF.PUBLISH_RE)}) THEN "
            f"coalesce(strftime(try_strptime({ts}, '%Y%m%d%H%M'), '%Y-%m-%dT%H:%M:%S'), '') ELSE '' END")


# --- TF-IDF ----------------------------------------------------------------------------------

CLEANED = ARTICLES + f""",
cleaned AS (
  SELECT doc_id, coalesce(language, 'en') AS language, title, description, content,
         {cleaned_text(first_non_empty('content', 'description'), "coalesce(language, 'en')")} AS cleaned_text
  FROM articles)"""


def tfidf_ctes(src: str = "cleaned", max_features: int | None = C.MAX_FEATURES) -> str:
    """CTEs tf(doc_id, term, tf), stats(term, df, cf), vocab(term, term_id, cf, df, idf), weights(...)."""
    return f"""toks AS (SELECT doc_id, {terms('cleaned_text')} AS t FROM {src}),
grams AS (SELECT doc_id, unnest({ngrams('t')}) AS term FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY doc_id, term),
stats AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term),
top AS (SELECT term, cf, df FROM stats {'' if max_features is None else f'ORDER BY cf DESC, term LIMIT {max_features}'}),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id, cf, df,
         ln((1.0 + n.n) / (1.0 + df)) + 1.0 AS idf
  FROM top CROSS JOIN (SELECT count(*) AS n FROM {src}) n),
weighted AS (SELECT tf.doc_id, v.term_id, v.term, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term)),
weights AS (
  SELECT doc_id, term_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM weighted)"""


# --- labelled data, split, classifier, metrics --------------------------------------------------

def model_ctes(p: str, task: str, seed: int = C.SPLIT_SEED, cuts=C.SPLIT_CUTS) -> str:
    """CTEs for one task, all prefixed ``p``: {p}_labelled, {p}_splits, {p}_nbm_*, {p}_pred, {p}_base.

    Needs CLEANED. {p}_pred / {p}_base: (doc_id, label, prediction[, prob]) on the test split.
    """
    return f"""{p}_labelled AS (
  SELECT c.doc_id, c.language, c.cleaned_text, CAST(l.{task} AS VARCHAR) AS label
  FROM cleaned c JOIN labels l USING (doc_id)
  WHERE c.cleaned_text IS NOT NULL AND c.cleaned_text <> '' AND l.{task} IS NOT NULL),
{p}_n AS (SELECT count(*) AS n FROM {p}_labelled),
{p}_splits AS (
  SELECT r.*, CASE WHEN r.rank < floor({cuts[0]}::DOUBLE * n.n) THEN 'train'
                   WHEN r.rank < floor({cuts[1]}::DOUBLE * n.n) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, CAST(row_number() OVER (ORDER BY md5('{seed}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1
                       AS BIGINT) AS rank
        FROM {p}_labelled) r CROSS JOIN {p}_n n),
{p}_nbm_docs AS (SELECT label FROM {p}_splits WHERE split = 'train'),
{p}_nbm_train AS (SELECT label, unnest({terms('cleaned_text')}) AS feature FROM {p}_splits WHERE split = 'train'),
{nb_fit(p + '_nbm', p + '_nbm_train')},
{p}_test AS (SELECT doc_id, label, cleaned_text FROM {p}_splits WHERE split = 'test'),
{nb_predict(p + '_pr', p + '_nbm', f"(SELECT doc_id AS id, unnest({terms('cleaned_text')}) AS feature FROM {p}_test)")},
{p}_prior_best AS (
  SELECT (SELECT label FROM {p}_nbm_priors ORDER BY log_prior DESC, label LIMIT 1) AS label,
         1.0 / sum(exp(log_prior - (SELECT max(log_prior) FROM {p}_nbm_priors))) AS prob
  FROM {p}_nbm_priors),
{p}_pred AS (
  SELECT t.doc_id, t.label, coalesce(r.label, b.label) AS prediction, coalesce(r.prob, b.prob) AS prob
  FROM {p}_test t LEFT JOIN {p}_pr r ON r.id = t.doc_id CROSS JOIN {p}_prior_best b),
{p}_major AS (
  SELECT label AS prediction FROM {p}_splits WHERE split = 'train'
  GROUP BY label ORDER BY count(*) DESC, label LIMIT 1),
{p}_base AS (SELECT t.doc_id, t.label, m.prediction FROM {p}_test t CROSS JOIN {p}_major m)"""


def per_class_ctes(p: str, pred: str) -> str:
    """CTEs {p}_cm(label, prediction, n) and {p}_pc(class, tp, fp, fn, support, precision, recall, f1)."""
    return f"""{p}_cm AS (SELECT label, prediction, count(*) AS n FROM {pred} GROUP BY label, prediction),
{p}_ts AS (SELECT label AS class, CAST(sum(n) AS DOUBLE) AS support,
                  CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS tp
           FROM {p}_cm GROUP BY label),
{p}_ps AS (SELECT prediction AS class, CAST(sum(n) AS DOUBLE) AS predicted FROM {p}_cm GROUP BY prediction),
{p}_pc0 AS (
  SELECT coalesce(t.class, s.class) AS class, coalesce(t.tp, 0) AS tp, coalesce(t.support, 0) AS support,
         coalesce(s.predicted, 0) AS predicted
  FROM {p}_ts t FULL OUTER JOIN {p}_ps s ON t.class = s.class),
{p}_pc AS (
  SELECT class, tp, predicted - tp AS fp, support - tp AS fn, support,
         CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
         CASE WHEN 2 * tp + (predicted - tp) + (support - tp) > 0
              THEN 2.0 * tp / (2.0 * tp + (predicted - tp) + (support - tp)) ELSE 0.0 END AS f1
  FROM {p}_pc0)"""


def summary_select(p: str) -> str:
    return f"""SELECT CASE WHEN sum(support) > 0 THEN sum(tp) / sum(support) ELSE 0.0 END AS accuracy,
       CASE WHEN sum(support) > 0 THEN sum(f1 * support) / sum(support) ELSE 0.0 END AS weighted_f1,
       avg(f1) AS macro_f1, CAST(sum(support) AS BIGINT) AS n FROM {p}_pc"""


# --- scoring --------------------------------------------------------------------------------

def nb_fit_grouped(n: str, train: str, docs: str, alpha: float = 1.0) -> str:
    """Per-group model: ``train(grp, label, feature)``, ``docs(grp, label)`` -> {n}_priors, {n}_cond."""
    return f"""{n}_counts AS (SELECT grp, label, feature, count(*) AS c FROM {train} GROUP BY grp, label, feature),
{n}_nd AS (SELECT grp, label, count(*) AS n FROM {docs} GROUP BY grp, label),
{n}_priors AS (SELECT grp, label, ln(n) - ln(sum(n) OVER (PARTITION BY grp)) AS log_prior FROM {n}_nd),
{n}_totals AS (SELECT grp, label, sum(c) AS t FROM {n}_counts GROUP BY grp, label),
{n}_v AS (SELECT grp, count(DISTINCT feature) AS v FROM {n}_counts GROUP BY grp),
{n}_cond AS (
  SELECT f.grp, f.feature, p.label, ln(coalesce(c.c, 0) + {alpha}) - ln(t.t + {alpha} * v.v) AS log_p
  FROM (SELECT DISTINCT grp, feature FROM {n}_counts) f
  JOIN {n}_priors p ON p.grp = f.grp
  LEFT JOIN {n}_counts c ON c.grp = f.grp AND c.feature = f.feature AND c.label = p.label
  JOIN {n}_totals t ON t.grp = p.grp AND t.label = p.label
  JOIN {n}_v v ON v.grp = f.grp)"""


def nb_predict_grouped(n: str, model: str, rows: str, text: str) -> str:
    """{n}(id, prediction, prob) for ``rows(id, grp, {text})``; rows without shared features get the
    group's prior choice; rows of a group without a model are absent."""
    return f"""{n}_f AS (SELECT id, grp, unnest({terms(text)}) AS feature FROM {rows}),
{n}_cnt AS (SELECT id, grp, feature, count(*) AS n FROM {n}_f GROUP BY id, grp, feature),
{n}_ll AS (SELECT q.id, q.grp, m.label, sum(q.n * m.log_p) AS ll
           FROM {n}_cnt q JOIN {model}_cond m ON m.grp = q.grp AND m.feature = q.feature
           GROUP BY q.id, q.grp, m.label),
{n}_sc AS (SELECT id, l.label, ll + log_prior AS score FROM {n}_ll l
           JOIN {model}_priors p ON p.grp = l.grp AND p.label = l.label),
{n}_mx AS (SELECT *, max(score) OVER (PARTITION BY id) AS m,
                  row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rk FROM {n}_sc),
{n}_best AS (SELECT id, max(CASE WHEN rk = 1 THEN label END) AS label, 1.0 / sum(exp(score - m)) AS prob
             FROM {n}_mx GROUP BY id),
{n}_pmx AS (SELECT *, max(log_prior) OVER (PARTITION BY grp) AS m,
                   row_number() OVER (PARTITION BY grp ORDER BY log_prior DESC, label) AS rk FROM {model}_priors),
{n}_pbest AS (SELECT grp, max(CASE WHEN rk = 1 THEN label END) AS label, 1.0 / sum(exp(log_prior - m)) AS prob
              FROM {n}_pmx GROUP BY grp),
{n} AS (SELECT r.id, coalesce(b.label, pb.label) AS prediction, coalesce(b.prob, pb.prob) AS prob
        FROM {rows} r JOIN {n}_pbest pb ON pb.grp = r.grp LEFT JOIN {n}_best b ON b.id = r.id)"""


def sentiment_ctes(task: str = "quality") -> str:
    """Needs CLEANED. CTE sentiment(doc_id, sentiment, sentiment_score) over every cleaned document."""
    return f"""sm_lab AS (
  SELECT c.doc_id, c.language AS grp, c.cleaned_text, CAST(l.{task} AS VARCHAR) AS label
  FROM cleaned c JOIN labels l USING (doc_id)
  WHERE c.cleaned_text IS NOT NULL AND c.cleaned_text <> '' AND l.{task} IS NOT NULL),
sm_train AS (SELECT grp, label, unnest({terms('cleaned_text')}) AS feature FROM sm_lab),
{nb_fit_grouped('smm', 'sm_train', 'sm_lab')},
sm_rows AS (SELECT doc_id AS id, language AS grp, cleaned_text FROM cleaned
            WHERE cleaned_text IS NOT NULL AND {non_blank('cleaned_text')}),
{nb_predict_grouped('smp', 'smm', 'sm_rows', 'cleaned_text')},
sentiment AS (
  SELECT c.doc_id,
         CASE WHEN c.cleaned_text IS NULL OR NOT {non_blank('c.cleaned_text')} THEN 'EMPTY'
              ELSE coalesce(p.prediction, 'ERROR') END AS sentiment,
         CASE WHEN c.cleaned_text IS NULL OR NOT {non_blank('c.cleaned_text')} THEN 0.0
              ELSE coalesce(p.prob, 0.0) END AS sentiment_score
  FROM cleaned c LEFT JOIN smp p ON p.id = c.doc_id)"""


def seed_ctes() -> str:
    """Needs tfidf_ctes (vocab). CTEs nl(n, first_label), seed_w(label, term, sw)."""
    seeds_clean = cleaned_text(first_non_empty("seed_text", "seed_text"), "'en'")
    return f"""cand AS (SELECT 'topic_' || CAST(item_id AS VARCHAR) AS label, text AS seed_text FROM benchmark),
nl AS (SELECT count(*) AS n, min(label) AS first_label FROM cand),
seed_c AS (SELECT label, {seeds_clean} AS cleaned_text FROM cand),
seed_t AS (SELECT label, {terms('cleaned_text')} AS t FROM seed_c),
seed_g AS (SELECT label, unnest({ngrams('t')}) AS term FROM seed_t),
seed_tf AS (SELECT label, term, count(*) AS tf FROM seed_g GROUP BY label, term),
seed_w0 AS (SELECT s.label, s.term, s.tf * v.idf AS w FROM seed_tf s JOIN vocab v USING (term)),
seed_w AS (SELECT label, term, w / sqrt(sum(w * w) OVER (PARTITION BY label)) AS sw FROM seed_w0)"""


def topic_ctes(docs: str, temperature: float = 0.1, weights: str = "weights", p: str = "") -> str:
    """Needs seed_ctes. ``docs(doc_id)`` lists the scored rows, ``weights(doc_id, term, weight)`` their vectors.
    CTE {p}topics(doc_id, topic, topic_score, n_labels, best_cos, n_present)."""
    return f"""{p}sims AS (SELECT d.doc_id, s.label, sum(d.weight * s.sw) AS cos
         FROM {weights} d JOIN seed_w s USING (term) GROUP BY d.doc_id, s.label),
{p}sims_r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY cos DESC, label) AS rk FROM {p}sims),
{p}per_doc AS (SELECT doc_id, max(CASE WHEN rk = 1 THEN label END) AS best, max(cos) AS best_cos,
                   sum(exp(cos / {temperature})) AS mass, count(*) AS n_present FROM {p}sims_r GROUP BY doc_id),
{p}topics AS (
  SELECT d.doc_id,
         CASE WHEN p.best IS NOT NULL AND (p.best_cos > 0 OR p.best <= nl.first_label) THEN p.best
              ELSE nl.first_label END AS topic,
         (CASE WHEN p.best IS NOT NULL AND (p.best_cos > 0 OR p.best <= nl.first_label)
               THEN exp(p.best_cos / {temperature}) ELSE 1.0 END)
           / (coalesce(p.mass, 0.0) + (nl.n - coalesce(p.n_present, 0))) AS topic_score,
         CAST(nl.n AS BIGINT) AS n_labels, coalesce(p.best_cos, 0) AS best_cos,
         CAST(coalesce(p.n_present, 0) AS BIGINT) AS n_present
  FROM {docs} d CROSS JOIN nl LEFT JOIN {p}per_doc p USING (doc_id))"""


# --- tuning of stored models, for every (language, task) -------------------------------------------

def tuning_ctes(rows: str, epochs: int = C.EPOCHS, seed: int = C.SPLIT_SEED, cuts=C.SPLIT_CUTS) -> str:
    """CTE tpred(language, task, model, doc_id, label, prediction) on each group's test rows.

    ``rows`` is a relation (language, task, doc_id, cleaned_text, label). The original model of a
    task has the counts of all languages' training rows; the tuned one adds ``epochs`` times the group's own.
    """
    g, gm = "language, task", "model, language, task"
    return f"""t_ok AS (SELECT {g} FROM {rows} GROUP BY {g} HAVING min(label) < max(label)),
t_rank AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY md5('{seed}:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS rk,
                  count(*) OVER (PARTITION BY {g}) AS n FROM {rows} JOIN t_ok USING ({g})),
t_sp AS (SELECT *, CASE WHEN rk < floor({cuts[0]}::DOUBLE * n) THEN 'train' WHEN rk < floor({cuts[1]}::DOUBLE * n) THEN 'val'
                        ELSE 'test' END AS split FROM t_rank),
t_ownf AS (SELECT {g}, label, feature, count(*) AS c FROM (
  SELECT {g}, label, unnest({terms('cleaned_text')}) AS feature FROM t_sp WHERE split = 'train') GROUP BY ALL),
t_ownd AS (SELECT {g}, label, count(*) AS n FROM t_sp WHERE split = 'train' GROUP BY ALL),
t_grp AS (SELECT DISTINCT {g} FROM t_ownd),
t_basef AS (SELECT g.language, g.task, o.label, o.feature, sum(o.c) AS c FROM t_ownf o JOIN t_grp g ON g.task = o.task GROUP BY ALL),
t_based AS (SELECT g.language, g.task, o.label, sum(o.n) AS n FROM t_ownd o JOIN t_grp g ON g.task = o.task GROUP BY ALL),
t_f AS (SELECT 'original' AS model, * FROM t_basef UNION ALL
  SELECT 'finetuned', {g}, label, feature, sum(c) FROM (
    SELECT * FROM t_basef UNION ALL SELECT {g}, label, feature, {epochs} * c FROM t_ownf) GROUP BY {g}, label, feature),
t_d AS (SELECT 'original' AS model, * FROM t_based UNION ALL
  SELECT 'finetuned', {g}, label, sum(n) FROM (SELECT * FROM t_based UNION ALL SELECT {g}, label, {epochs} * n FROM t_ownd) GROUP BY {g}, label),
t_t AS (SELECT {gm}, label, sum(c) AS t FROM t_f GROUP BY ALL),
t_v AS (SELECT {gm}, count(DISTINCT feature) AS v FROM t_f GROUP BY ALL),
t_p AS (SELECT {gm}, label, ln(n) - ln(sum(n) OVER (PARTITION BY {gm})) AS prior FROM t_d),
t_df AS (SELECT {g}, doc_id, feature, count(*) AS n FROM (
  SELECT {g}, doc_id, unnest({terms('cleaned_text')}) AS feature FROM t_sp WHERE split = 'test') GROUP BY ALL),
t_known AS (SELECT DISTINCT {gm}, feature FROM t_f),
t_x AS (SELECT {gm}, doc_id, label, sum(d.n * (ln(coalesce(f.c, 0) + 1.0) - ln(coalesce(t.t, 0) + 1.0 * v.v))) AS s
  FROM t_df d JOIN t_known k USING ({g}, feature) JOIN t_p p USING ({gm}) JOIN t_v v USING ({gm})
  LEFT JOIN t_f f USING ({gm}, label, feature) LEFT JOIN t_t t USING ({gm}, label) GROUP BY ALL),
t_sc AS (SELECT p.model, r.language, r.task, r.doc_id, r.label AS truth, p.label, round(p.prior + coalesce(x.s, 0), 6) AS score
  FROM (SELECT {g}, doc_id, label FROM t_sp WHERE split = 'test') r
  JOIN (SELECT {gm}, label, prior FROM t_p) p ON p.language = r.language AND p.task = r.task
  LEFT JOIN t_x x ON x.model = p.model AND x.language = p.language AND x.task = p.task AND x.label = p.label AND x.doc_id = r.doc_id),
tpred AS (SELECT {gm}, doc_id, truth AS label, label AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY {gm}, doc_id ORDER BY score DESC, label) AS best FROM t_sc) WHERE best = 1)"""


def grouped_class_ctes(p: str, pred: str, keys: str) -> str:
    """Like ``per_class_ctes`` for every combination of the columns ``keys``: {p}_pc(keys, class, ...)."""
    return f"""{p}_cm AS (SELECT {keys}, label, prediction, count(*) AS n FROM {pred} GROUP BY ALL),
{p}_cl AS (SELECT {keys}, label AS class FROM {p}_cm UNION SELECT {keys}, prediction FROM {p}_cm),
{p}_ct AS (SELECT {keys}, class, CAST(coalesce(sum(n) FILTER (WHERE label = class), 0) AS DOUBLE) AS support,
    CAST(coalesce(sum(n) FILTER (WHERE prediction = class), 0) AS DOUBLE) AS predicted,
    CAST(coalesce(sum(n) FILTER (WHERE label = class AND prediction = class), 0) AS DOUBLE) AS tp
  FROM {p}_cl JOIN {p}_cm USING ({keys}) GROUP BY ALL),
{p}_pc AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall,
    CASE WHEN support + predicted > 0 THEN 2.0 * tp / (support + predicted) ELSE 0.0 END AS f1 FROM {p}_ct)"""


def grouped_summary(p: str, keys: str) -> str:
    return f"""SELECT {keys}, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS weighted_f1,
  avg(f1) AS macro_f1, CAST(sum(support) AS BIGINT) AS n FROM {p}_pc GROUP BY {keys}"""


def grouped_report(p: str, keys: str) -> str:
    """Rows (keys, name, precision, recall, f1, support): classes, accuracy, macro avg, weighted avg."""
    avg = ", ".join(f"avg({m}) AS {m}" for m in ("precision", "recall", "f1"))
    weighted = ", ".join(f"sum({m} * support) / sum(support) AS {m}" for m in ("precision", "recall", "f1"))
    return f"""SELECT {keys}, class AS name, precision, recall, f1, support FROM {p}_pc
UNION ALL SELECT {keys}, 'accuracy', NULL, NULL, sum(tp) / sum(support), sum(support) FROM {p}_pc GROUP BY {keys}
UNION ALL SELECT {keys}, 'macro avg', {avg}, sum(support) FROM {p}_pc GROUP BY {keys}
UNION ALL SELECT {keys}, 'weighted avg', {weighted}, sum(support) FROM {p}_pc GROUP BY {keys}"""
