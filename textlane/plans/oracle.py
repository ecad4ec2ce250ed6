"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code path: plain CTEs over the driver's
views.  Shared pieces are small functions returning CTE text.
"""

from __future__ import annotations

from textlane.functions.expr import WORD_PATTERN
from textlane.functions.stem import stem_sql
from textlane.functions.stopwords import sql_list
from textlane.operators.text_chain import NOUN_TAG, TAG_RULES

STOP = sql_list()
SEED, TEST = 42, 0.3


def unit_hash(expr: str, seed: int) -> str:
    return f"(('0x' || substr(md5(CAST({expr} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT / 4294967296.0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TOK = (f"tok AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '{WORD_PATTERN}')) AS term FROM documents)",
       f"ctok AS (SELECT * FROM tok WHERE term NOT IN ({STOP}))")
TF = ("tf AS (SELECT doc_id, term, count(*) AS tf FROM ctok GROUP BY doc_id, term)",
      "vocab AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term)",
      "ndocs AS (SELECT count(*) AS n FROM documents)")
FEAT = ("rawf AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * (ln((1 + ndocs.n) / (1 + vocab.df)) + 1) AS w0 "
        "FROM tf JOIN vocab USING (term) CROSS JOIN ndocs)",
        "feat AS (SELECT doc_id, term, tf, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY doc_id)) AS w FROM rawf)",
        "vsize AS (SELECT count(*) AS v FROM vocab)")


def split_cte(name: str, source: str, label_expr: str, seed: int = SEED, test: float = TEST) -> str:
    return (f"{name} AS (SELECT doc_id, {label_expr} AS y, CASE WHEN {unit_hash('doc_id', seed)} < {test} "
            f"THEN 'test' ELSE 'train' END AS split FROM {source})")


LANG_SPLIT = split_cte("sp", "documents", "lang")
QUALITY_SPLIT = split_cte("sp", "labels", "CAST(quality AS VARCHAR)")


def nb_ctes(alpha: float = 1.0, digits: int = 9) -> tuple[str, ...]:
    """Dense-form NB fit on sp(train) and scores/predictions/probabilities for all sp rows."""
    a = repr(float(alpha))
    return (
        "cnt AS (SELECT sp.y AS label, feat.term, sum(feat.w) AS n_ct FROM feat JOIN sp USING (doc_id) "
        "WHERE sp.split = 'train' GROUP BY sp.y, feat.term)",
        "cls AS (SELECT y AS label, count(*) AS n_docs FROM sp WHERE split = 'train' GROUP BY y)",
        "tot AS (SELECT label, sum(n_ct) AS total FROM cnt GROUP BY label)",
        "cls2 AS (SELECT cls.label, ln(n_docs / (SELECT sum(n_docs) FROM cls)) AS log_prior, "
        "coalesce(tot.total, 0) AS total FROM cls LEFT JOIN tot USING (label))",
        f"theta AS (SELECT cls2.label, vocab.term, ln((coalesce(cnt.n_ct, 0) + {a}) / (cls2.total + {a} * (SELECT v FROM vsize))) AS lt "
        "FROM cls2 CROSS JOIN vocab LEFT JOIN cnt ON cnt.label = cls2.label AND cnt.term = vocab.term)",
        "dsum AS (SELECT feat.doc_id, theta.label, sum(feat.w * theta.lt) AS s FROM feat JOIN theta USING (term) "
        "GROUP BY feat.doc_id, theta.label)",
        "score AS (SELECT sp.doc_id, cls2.label, cls2.log_prior + coalesce(dsum.s, 0) AS score FROM sp CROSS JOIN cls2 "
        "LEFT JOIN dsum ON dsum.doc_id = sp.doc_id AND dsum.label = cls2.label)",
        "lse AS (SELECT doc_id, max(score) + ln(sum(exp(score - mx))) AS l FROM "
        "(SELECT doc_id, score, max(score) OVER (PARTITION BY doc_id) AS mx FROM score) GROUP BY doc_id)",
        "pred AS (SELECT doc_id, label AS p FROM (SELECT doc_id, label, row_number() OVER "
        "(PARTITION BY doc_id ORDER BY score DESC, label) AS rn FROM score) WHERE rn = 1)",
        "pj AS (SELECT sp.doc_id, sp.split, sp.y, pred.p FROM sp JOIN pred USING (doc_id))",
        f"proba AS (SELECT score.doc_id, sp.split, sp.y, score.label, round(exp(score.score - lse.l), {digits}) AS prob "
        "FROM score JOIN lse USING (doc_id) JOIN sp USING (doc_id))",
    )


PERCLASS = (
    "cc AS (SELECT split, y, p, count(*) AS n FROM pj GROUP BY split, y, p)",
    "tt AS (SELECT split, y AS label, sum(n) AS support FROM cc GROUP BY split, y)",
    "pt AS (SELECT split, p AS label, sum(n) AS n_pred FROM cc GROUP BY split, p)",
    "tpc AS (SELECT split, y AS label, n AS tp FROM cc WHERE y = p)",
    "pc0 AS (SELECT coalesce(tt.split, pt.split) AS split, coalesce(tt.label, pt.label) AS label, "
    "coalesce(tt.support, 0) AS support, coalesce(pt.n_pred, 0) AS n_pred FROM tt FULL JOIN pt "
    "ON tt.split = pt.split AND tt.label = pt.label)",
    "pc1 AS (SELECT pc0.*, coalesce(tpc.tp, 0) AS tp FROM pc0 LEFT JOIN tpc USING (split, label))",
    "pc2 AS (SELECT *, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS precision, "
    "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM pc1)",
    "pc AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM pc2)",
)

NB_PIPE_LANG = with_(*TOK, *TF, *FEAT, LANG_SPLIT, *nb_ctes())
NB_PIPE_QUALITY = with_(*TOK, *TF, *FEAT, QUALITY_SPLIT, *nb_ctes())
NB_LANG_METRICS = with_(*TOK, *TF, *FEAT, LANG_SPLIT, *nb_ctes(), *PERCLASS)
NB_QUALITY_METRICS = with_(*TOK, *TF, *FEAT, QUALITY_SPLIT, *nb_ctes(), *PERCLASS)

WEIGHTED = ("SELECT split, round(sum(precision * support) / sum(support), 6) AS precision, "
            "round(sum(recall * support) / sum(support), 6) AS recall, "
            "round(sum(f1 * support) / sum(support), 6) AS f1, CAST(sum(support) AS BIGINT) AS n FROM pc GROUP BY split")


def auc_sql() -> str:
    return (
        "dist AS (SELECT split, label, prob AS s, sum(CASE WHEN y = label THEN 1 ELSE 0 END) AS pos, "
        "sum(CASE WHEN y <> label THEN 1 ELSE 0 END) AS neg FROM proba GROUP BY split, label, prob),\n"
        "run AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split, label ORDER BY s "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM dist),\n"
        "percls AS (SELECT split, label, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS pos "
        "FROM run GROUP BY split, label)\n"
    )


def text_chain_sql() -> str:
    """(doc_id, processed_text) for all documents, DuckDB form of the cleaning chain."""
    tag = "CASE " + " ".join(f"WHEN regexp_matches(stem, '{p}') THEN '{t}'" for p, t in TAG_RULES) + f" ELSE '{NOUN_TAG}' END"
    return (
        f"ptok AS (SELECT doc_id, unnest(toks) AS term, unnest(generate_series(0, len(toks) - 1)) AS pos FROM "
        f"(SELECT doc_id, regexp_extract_all(lower(text), '{WORD_PATTERN}') AS toks FROM documents)),\n"
        f"pctok AS (SELECT * FROM ptok WHERE term NOT IN ({STOP})),\n"
        f"stems AS ({stem_sql('SELECT DISTINCT term FROM pctok')}),\n"
        f"tagged AS (SELECT pctok.doc_id, pctok.pos, stems.stem, {tag} AS tag FROM pctok JOIN stems USING (term)),\n"
        "joined AS (SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS processed_text FROM tagged "
        f"WHERE tag = '{NOUN_TAG}' GROUP BY doc_id),\n"
        "ptext AS (SELECT d.doc_id, coalesce(j.processed_text, '') AS processed_text FROM documents d "
        "LEFT JOIN joined j USING (doc_id))\n"
    )


def bounded_ctes(min_df: int = 2, max_df: float = 0.95) -> tuple[str, ...]:
    return (f"bvocab AS (SELECT * FROM vocab WHERE df >= {min_df} AND df <= {max_df} * (SELECT n FROM ndocs))",
            "brawf AS (SELECT tf.doc_id, tf.term, tf.tf, tf.tf * (ln((1 + ndocs.n) / (1 + bvocab.df)) + 1) AS w0 "
            "FROM tf JOIN bvocab USING (term) CROSS JOIN ndocs)",
            "bfeat AS (SELECT doc_id, term, tf, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY doc_id)) AS w FROM brawf)")


def nmf_step_sql(k: int = 4, seed: int = 123, eps: float = 1e-9) -> str:
    """One H then W multiplicative update from md5 start values, on the bounded TF-IDF."""
    topics = f"range(0, {k})"
    hw = unit_hash("CAST(doc_id AS VARCHAR) || '|' || CAST(t.topic AS VARCHAR)", seed)
    hh = unit_hash("term || '|' || CAST(t.topic AS VARCHAR)", seed)
    return (
        "X AS (SELECT doc_id, term, w AS x FROM bfeat),\n"
        f"W0 AS (SELECT doc_id, t.topic, {hw} AS w "
        f"FROM (SELECT DISTINCT doc_id FROM X) CROSS JOIN (SELECT unnest({topics}) AS topic) t),\n"
        f"H0 AS (SELECT term, t.topic, {hh} AS h "
        f"FROM (SELECT DISTINCT term FROM X) CROSS JOIN (SELECT unnest({topics}) AS topic) t),\n"
        "WtX AS (SELECT X.term, W0.topic, sum(X.x * W0.w) AS num FROM X JOIN W0 USING (doc_id) GROUP BY X.term, W0.topic),\n"
        "WtW AS (SELECT a.topic, b.topic AS topic2, sum(a.w * b.w) AS g FROM W0 a JOIN W0 b USING (doc_id) GROUP BY a.topic, b.topic),\n"
        "WtWH AS (SELECT H0.term, WtW.topic, sum(WtW.g * H0.h) AS den FROM H0 JOIN WtW ON WtW.topic2 = H0.topic GROUP BY H0.term, WtW.topic),\n"
        f"H1 AS (SELECT H0.term, H0.topic, H0.h * coalesce(WtX.num, 0) / (WtWH.den + {eps}) AS h FROM H0 "
        "LEFT JOIN WtX USING (term, topic) JOIN WtWH USING (term, topic)),\n"
        "XHt AS (SELECT X.doc_id, H1.topic, sum(X.x * H1.h) AS num FROM X JOIN H1 USING (term) GROUP BY X.doc_id, H1.topic),\n"
        "HHt AS (SELECT a.topic, b.topic AS topic2, sum(a.h * b.h) AS g FROM H1 a JOIN H1 b USING (term) GROUP BY a.topic, b.topic),\n"
        "WHHt AS (SELECT W0.doc_id, HHt.topic, sum(HHt.g * W0.w) AS den FROM W0 JOIN HHt ON HHt.topic2 = W0.topic GROUP BY W0.doc_id, HHt.topic),\n"
        f"W1 AS (SELECT W0.doc_id, W0.topic, W0.w * coalesce(XHt.num, 0) / (WHHt.den + {eps}) AS w FROM W0 "
        "LEFT JOIN XHt USING (doc_id, topic) JOIN WHHt USING (doc_id, topic))\n"
    )


def tickets_sql() -> str:
    return ("tickets AS (SELECT doc_id, nullif(text, '') AS complaint_what_happened, "
            "source || ' + ' || nullif(lang, 'es') AS ticket_classification FROM documents "
            "WHERE nullif(text, '') IS NOT NULL AND (source || ' + ' || nullif(lang, 'es')) IS NOT NULL)\n")


def version_sql() -> str:
    return ("vers AS (SELECT o_custkey AS name, o_orderkey, o_orderstatus AS stage, row_number() OVER "
            "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version FROM orders)\n")


def last_value_sql() -> str:
    return ("lastv AS (SELECT user_id, event_type, value FROM (SELECT user_id, event_type, value, row_number() OVER "
            "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),\n"
            "purch AS (SELECT user_id, value AS purchase FROM lastv WHERE event_type = 'purchase')\n")


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flagship"] = (NB_LANG_METRICS + ", acc AS (SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                     "FROM pj GROUP BY split), w AS (" + WEIGHTED + ") SELECT w.split, acc.accuracy, w.precision, w.recall, w.f1, w.n "
                     "FROM w JOIN acc USING (split)")
    # sources
    q["s1_json_flatten"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events"
    q["s2_csv_roundtrip"] = ("SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS sum_n_chars, "
                             "CAST(sum(length(text)) AS BIGINT) AS sum_length FROM documents GROUP BY lang")
    q["s5_label_map"] = "SELECT CAST(r_regionkey AS VARCHAR) AS idx, r_name AS label FROM region"
    q["s6_snapshot_roundtrip"] = (with_(LANG_SPLIT) + "SELECT y AS lang, count(*) AS n_test FROM sp WHERE split = 'test' GROUP BY y")
    q["s10_runstore_scan"] = ("SELECT user_id, key, count(*) AS n_values, round(max(CASE WHEN rn = 1 THEN value END), 6) AS last_value, "
                              "max(event_id) AS max_step FROM (SELECT user_id, event_type AS key, value, event_id, row_number() OVER "
                              "(PARTITION BY user_id, event_type ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM events) "
                              "GROUP BY user_id, key")
    # cleaning
    q["p_clean"] = "WITH " + tickets_sql() + "SELECT doc_id, md5(complaint_what_happened) AS complaint_md5, ticket_classification FROM tickets"
    q["p7_dense_index"] = ("WITH " + tickets_sql() + "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS ticket_index, "
                           "'ticket_' || CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS ticket_name FROM tickets")
    q["p8_shape"] = "SELECT count(*) AS n_rows, 5 AS n_cols FROM documents"
    q["p9_value_counts"] = "SELECT lang, count(*) AS n FROM documents GROUP BY lang"
    q["p10_sample_n"] = (f"SELECT doc_id, lang, n_chars FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '|{SEED}'), doc_id LIMIT 5")
    q["p11_head"] = "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5"
    q["p12_distinct"] = "SELECT DISTINCT source FROM documents"
    masked = "('xx/xx/2019 ' || replace(text, 'a', 'xxxx') || ' box/y xxxxx')"
    stripped = f"replace(regexp_replace({masked}, 'x+/', '', 'g'), 'xxxx', '')"
    q["p13_mask_strip"] = f"SELECT doc_id, length({stripped}) AS n_chars_out, md5({stripped}) AS text_md5 FROM documents"
    q["p15_bround"] = ("SELECT event_id, (event_id % 1000) / 8.0 AS x, round_even((event_id % 1000) / 8.0, 2) AS half_even, "
                       "round((event_id % 1000) / 8.0, 2) AS half_up FROM events")
    # text
    q["t2_tokens"] = with_(TOK[0]) + "SELECT lang, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM tok GROUP BY lang"
    q["t3_stopwords"] = with_(*TOK) + "SELECT lang, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM ctok GROUP BY lang"
    q["t4_stem"] = with_(*TOK, f"st AS ({stem_sql('SELECT DISTINCT term FROM ctok')})") + "SELECT term, stem FROM st"
    tag_t = "CASE " + " ".join(f"WHEN regexp_matches(stem, '{p}') THEN '{t}'" for p, t in TAG_RULES) + f" ELSE '{NOUN_TAG}' END"
    q["t5_noun_filter"] = with_(*TOK) + f"SELECT lang, {tag_t.replace('stem', 'term')} AS tag, count(*) AS n_tokens FROM ctok GROUP BY ALL"
    q["t7_processed_text"] = "WITH " + text_chain_sql() + "SELECT doc_id, md5(processed_text) AS text_md5, length(processed_text) AS n_chars FROM ptext"
    q["t8_pipeline_clean"] = ("WITH " + text_chain_sql() + ", " + tickets_sql() +
                              "SELECT t.doc_id, t.ticket_classification, "
                              "md5(replace(regexp_replace(p.processed_text, 'x+/', '', 'g'), 'xxxx', '')) AS text_md5 "
                              "FROM tickets t JOIN ptext p USING (doc_id)")
    # features
    q["f1_term_counts"] = with_(*TOK, *TF) + "SELECT term, df AS doc_freq, CAST(cf AS BIGINT) AS term_freq FROM vocab"
    q["f2_tfidf"] = with_(*TOK, *TF, *FEAT) + "SELECT doc_id, term, tf, round(w, 6) AS w FROM feat"
    q["f3_tfidf_bounded"] = with_(*TOK, *TF, *bounded_ctes()) + "SELECT doc_id, term, tf, round(w, 6) AS w FROM bfeat"
    q["f4_vocab_size"] = with_(*TOK, *TF, *bounded_ctes()) + "SELECT count(*) AS vocab_size FROM bvocab"
    q["f6_top_words"] = (with_(*TOK, *TF, *FEAT) +
                         ", sums AS (SELECT d.lang, feat.term, round(sum(feat.w), 9) AS weight FROM feat JOIN documents d USING (doc_id) "
                         "GROUP BY d.lang, feat.term) SELECT lang, rank, term, weight FROM (SELECT *, row_number() OVER "
                         "(PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM sums) WHERE rank <= 15")
    q["f9_string_argmax"] = ("WITH " + tickets_sql() + ", t2 AS (SELECT doc_id, complaint_what_happened AS c0, ticket_classification AS c1, "
                             "CAST(doc_id AS VARCHAR) AS c2 FROM tickets) SELECT doc_id, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 0 "
                             "WHEN c1 >= c2 THEN 1 ELSE 2 END AS relevant_topics FROM t2")
    q["f10_label_decode"] = ("SELECT n.n_nationkey, n.n_regionkey, r.r_name AS region_label FROM nation n "
                             "LEFT JOIN region r ON CAST(n.n_regionkey AS VARCHAR) = CAST(r.r_regionkey AS VARCHAR)")
    q["f11_label_encode"] = ("SELECT doc_id, lang, CAST(dense_rank() OVER (ORDER BY lang) - 1 AS INTEGER) AS lang_idx FROM documents")
    # models
    q["m1_nb_fit"] = (NB_PIPE_LANG + "SELECT cnt.label, cnt.term, round(ln((cnt.n_ct + 1.0) / (cls2.total + 1.0 * (SELECT v FROM vsize))), 6) AS log_theta, "
                      "round(cls2.log_prior, 6) AS log_prior FROM cnt JOIN cls2 USING (label)")
    q["m2_nb_predict"] = NB_PIPE_LANG + "SELECT doc_id, split, y, p FROM pj"
    q["m2_nb_proba"] = NB_PIPE_QUALITY + "SELECT doc_id, label, round(prob, 6) AS prob FROM proba"
    q["m9_batch_score"] = NB_PIPE_LANG + "SELECT doc_id, p FROM pj WHERE split = 'test'"
    # metrics
    q["e1_accuracy"] = NB_PIPE_QUALITY + "SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pj GROUP BY split"
    q["e2_prf_weighted"] = NB_QUALITY_METRICS + WEIGHTED
    q["e3_f1_micro_macro"] = (NB_QUALITY_METRICS + "SELECT split, round(sum(tp) / sum(support), 6) AS f1_micro, "
                              "round(avg(f1), 6) AS f1_macro FROM pc GROUP BY split")
    q["e4_auc_ovr"] = (NB_PIPE_QUALITY + ", " + auc_sql() +
                       "SELECT split, round(sum(auc * pos) / sum(pos), 6) AS auc FROM percls GROUP BY split")
    q["e5_confusion"] = (NB_PIPE_LANG + "SELECT split, y, " +
                         ", ".join(f"CAST(sum(CASE WHEN p = '{l}' THEN 1 ELSE 0 END) AS BIGINT) AS {l}" for l in ("de", "en", "es", "fr")) +
                         " FROM pj GROUP BY split, y")
    q["e6_report"] = (NB_QUALITY_METRICS +
                      "SELECT split, label AS row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
                      "CAST(support AS BIGINT) AS support FROM pc UNION ALL "
                      "SELECT split, 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc GROUP BY split "
                      "UNION ALL SELECT split, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), "
                      "CAST(sum(support) AS BIGINT) FROM pc GROUP BY split UNION ALL SELECT split, 'weighted avg', "
                      "round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
                      "round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc GROUP BY split")
    q["e7_train_test"] = (NB_QUALITY_METRICS + ", " + auc_sql() + ", w AS (SELECT split, sum(precision * support) / sum(support) AS precision, "
                          "sum(recall * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1 FROM pc GROUP BY split), "
                          "acc AS (SELECT split, avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM pj GROUP BY split), "
                          "au AS (SELECT split, sum(auc * pos) / sum(pos) AS auc FROM percls GROUP BY split), "
                          "allm AS (SELECT w.split, au.auc, acc.accuracy, w.precision, w.recall, w.f1 FROM w JOIN acc USING (split) "
                          "LEFT JOIN au USING (split)) "
                          "SELECT metric, split, round(value, 6) AS value FROM (UNPIVOT allm ON auc, accuracy, precision, recall, f1 "
                          "INTO NAME metric VALUE value)")
    q["e8_production_eval"] = NB_PIPE_LANG + "SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pj WHERE split = 'test'"
    # sampling
    q["g1_split"] = with_(LANG_SPLIT) + "SELECT split, y AS lang, count(*) AS n FROM sp GROUP BY split, y"
    h = f"('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|{SEED}'), 1, 8))::BIGINT"
    q["g1_split_exact"] = (f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {h}, doc_id) AS rn FROM documents) "
                           f"WHERE rn <= ceil({TEST} * (SELECT count(*) FROM documents))")
    q["g2_folds"] = (f"SELECT doc_id, lang, CAST((row_number() OVER (PARTITION BY lang ORDER BY {unit_hash('doc_id', 37)}, doc_id) - 1) % 5 AS INTEGER) AS fold "
                     "FROM documents")
    q["g4_class_weight"] = ("SELECT lang, count(*) AS n_c, round((SELECT count(*) FROM documents) / "
                            "((SELECT count(DISTINCT lang) FROM documents) * count(*)), 6) AS weight FROM documents GROUP BY lang")
    # runs
    q["r1_runs_wide"] = ("WITH " + last_value_sql() + "SELECT user_id, " +
                         ", ".join(f"max(CASE WHEN event_type = '{e}' THEN value END) AS {e}" for e in ("click", "error", "purchase", "signup", "view")) +
                         " FROM lastv GROUP BY user_id")
    q["r3_search_filter"] = ("WITH " + last_value_sql() + "SELECT user_id, purchase FROM purch WHERE purchase > 10 "
                             "AND user_id IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 50) "
                             "AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 95)")
    q["r4_top_runs"] = "WITH " + last_value_sql() + "SELECT user_id, purchase FROM purch ORDER BY purchase DESC NULLS LAST, user_id LIMIT 4"
    q["r5_versions"] = "WITH " + version_sql() + "SELECT name, o_orderkey, version FROM vers"
    q["r6_latest_versions"] = "WITH " + version_sql() + "SELECT name, stage, max(version) AS latest_version FROM vers GROUP BY name, stage"
    q["r7_stage_state"] = ("WITH " + version_sql() + "SELECT name, version, CASE WHEN lead(version) OVER (PARTITION BY name, stage "
                           "ORDER BY version) IS NOT NULL THEN 'Archived' ELSE stage END AS current_stage FROM vers")
    q["r7_no_archive"] = "WITH " + version_sql() + "SELECT name, version, stage AS current_stage FROM vers"
    q["r8_run_duration"] = ("SELECT user_id, min(ts) AS start_ts, max(ts) AS end_ts, epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us, "
                            "count(*) AS n_values FROM events GROUP BY user_id")
    # topics
    q["f5_nmf_step"] = (with_(*TOK, *TF, *bounded_ctes()) + ", " + nmf_step_sql() +
                        "SELECT doc_id, topic, round(w, 6) AS w FROM W1")
    q["f7_doc_topic"] = (with_(*TOK, *TF, *bounded_ctes()) + ", " + nmf_step_sql() + "SELECT doc_id, " +
                         ", ".join(f"round_even(max(CASE WHEN topic = {i} THEN w END), 2) AS topic{i}" for i in range(4)) +
                         " FROM W1 GROUP BY doc_id")
    q["f8_dominant_topic"] = (with_(*TOK, *TF, *bounded_ctes()) + ", " + nmf_step_sql() +
                              "SELECT doc_id, topic FROM (SELECT doc_id, topic, row_number() OVER (PARTITION BY doc_id "
                              "ORDER BY round(w, 9) DESC, topic) AS rn FROM W1) WHERE rn = 1")
    # pipelines and grids
    l1_tok = f"ctok AS (SELECT doc_id, unnest(regexp_extract_all(lower(processed_text), '{WORD_PATTERN}')) AS term FROM ptext)"
    q["l1_pipeline_nb"] = ("WITH " + text_chain_sql() + ",\n" +
                           ",\n".join([l1_tok, *TF, *FEAT, split_cte("sp", "documents", "lang", 37, 0.2), *nb_ctes(), *PERCLASS]) +
                           "\n, acc AS (SELECT split, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                           "FROM pj GROUP BY split), w AS (" + WEIGHTED + ") SELECT w.split, acc.accuracy, w.precision, w.recall, "
                           "w.f1, w.n FROM w JOIN acc USING (split)")
    q["m7_nb_grid"] = (with_(*TOK, *TF, *FEAT, LANG_SPLIT) + ", " + nb_grid_sql() +
                       "SELECT alpha, round(avg(accuracy), 6) AS mean_accuracy FROM gacc GROUP BY alpha")
    al = ", ".join(repr(float(a)) for a in (1.0, 0.1, 0.01, 0.001, 0.0001))
    q["m8_nb_best"] = (with_(*TOK, *TF, *FEAT, LANG_SPLIT) + ", " + nb_grid_sql() +
                       ", gm AS (SELECT alpha, round(avg(accuracy), 6) AS mean_accuracy FROM gacc GROUP BY alpha) "
                       f"SELECT alpha AS best_alpha, mean_accuracy AS best_score FROM gm "
                       f"ORDER BY mean_accuracy DESC, list_position([{al}], alpha) LIMIT 1")
    q["l1_staged_nb"] = q["l1_pipeline_nb"]
    q["g3_smote"] = smote_sql()
    q["g3_smote_sparse"] = smote_sparse_sql()
    q["r1_stream_latest"] = "WITH " + last_value_sql() + "SELECT user_id, event_type, value FROM lastv"
    return q


def smote_sql(k: int = 5, seed: int = 7) -> str:
    """Brute-force exact kNN inside the minority class, then the same hashed choices."""
    lam = unit_hash("id || '|' || CAST(j AS VARCHAR)", seed)
    return (
        "WITH e AS (SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN label = 0 THEN '0' ELSE 'rest' END AS cls, "
        "CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),\n"
        "cnt AS (SELECT cls, count(*) AS n_c FROM e GROUP BY cls),\n"
        "mino AS (SELECT cls, n_c, (SELECT max(n_c) FROM cnt) - n_c AS need FROM cnt WHERE n_c < (SELECT max(n_c) FROM cnt)),\n"
        "pts AS (SELECT e.* FROM e JOIN mino USING (cls)),\n"
        "flat AS (SELECT id, cls, unnest(vec) AS v, unnest(range(len(vec))) AS i FROM pts),\n"
        "pairs AS (SELECT a.id, b.id AS nn_id, sum((a.v - b.v) * (a.v - b.v)) AS d FROM flat a JOIN flat b "
        "ON a.cls = b.cls AND a.i = b.i AND a.id <> b.id GROUP BY a.id, b.id),\n"
        f"nn AS (SELECT id, nn_id, nn_rank FROM (SELECT id, nn_id, row_number() OVER (PARTITION BY id ORDER BY d, nn_id) - 1 "
        f"AS nn_rank FROM pairs) WHERE nn_rank < {k}),\n"
        "nnn AS (SELECT id, count(*) AS n_nn FROM nn GROUP BY id),\n"
        f"sd AS (SELECT pts.id, pts.vec, mino.n_c, mino.need, row_number() OVER (PARTITION BY pts.cls ORDER BY "
        f"{unit_hash('pts.id', seed)}, pts.id) - 1 AS r FROM pts JOIN mino USING (cls)),\n"
        "jobs0 AS (SELECT id, vec, CAST(floor(need / n_c) AS BIGINT) + CASE WHEN r < need % n_c THEN 1 ELSE 0 END AS m FROM sd),\n"
        "jobs AS (SELECT id, vec, unnest(range(0, m)) AS j FROM jobs0 WHERE m > 0),\n"
        f"jobs2 AS (SELECT jobs.*, CAST(('0x' || substr(md5(id || '|' || CAST(j AS VARCHAR) || '|nn{seed}'), 1, 8))::BIGINT "
        f"% nnn.n_nn AS INTEGER) AS nn_rank, {lam} AS lam "
        "FROM jobs JOIN nnn USING (id)),\n"
        "picked AS (SELECT jobs2.id, jobs2.j, jobs2.lam, jobs2.vec, nn.nn_id FROM jobs2 JOIN nn USING (id, nn_rank)),\n"
        "newv AS (SELECT p.id, p.j, p.lam, p.nn_id, unnest(p.vec) AS a, unnest(pv.vec) AS b FROM picked p "
        "JOIN pts pv ON pv.id = p.nn_id)\n"
        "SELECT id || '_s' || CAST(j AS VARCHAR) AS new_id, id AS src_id, nn_id, round(lam, 9) AS lam, "
        "round(sum(a + lam * (b - a)), 6) AS vec_sum FROM newv GROUP BY id, j, lam, nn_id"
    )


def smote_sparse_sql(k: int = 5, seed: int = 7) -> str:
    """All products of the minority class's rows, then the same hashed choices."""
    return with_(
        *TOK, *TF, *FEAT, QUALITY_SPLIT,
        "x AS (SELECT CAST(doc_id AS VARCHAR) AS id, y AS cls, term, w FROM feat JOIN sp USING (doc_id) WHERE split = 'train')",
        "e AS (SELECT DISTINCT id, cls FROM x)",
        "cnt AS (SELECT cls, count(*) AS n_c FROM e GROUP BY cls)",
        "mino AS (SELECT cls, n_c, (SELECT max(n_c) FROM cnt) - n_c AS need FROM cnt WHERE n_c < (SELECT max(n_c) FROM cnt))",
        "pts AS (SELECT e.* FROM e JOIN mino USING (cls))",
        "dots AS (SELECT a.id, b.id AS nn_id, sum(a.w * b.w) AS dot FROM x a JOIN x b ON a.cls = b.cls AND a.term = b.term AND a.id <> b.id "
        "JOIN mino ON mino.cls = a.cls GROUP BY a.id, b.id)",
        "pairs AS (SELECT a.id, b.id AS nn_id, round(coalesce(dot, 0), 9) AS dot FROM pts a JOIN pts b ON a.cls = b.cls AND a.id <> b.id "
        "LEFT JOIN dots ON dots.id = a.id AND dots.nn_id = b.id)",
        f"nn AS (SELECT id, nn_id, nn_rank FROM (SELECT id, nn_id, row_number() OVER (PARTITION BY id ORDER BY dot DESC, nn_id) - 1 "
        f"AS nn_rank FROM pairs) WHERE nn_rank < {k})",
        "nnn AS (SELECT id, count(*) AS n_nn FROM nn GROUP BY id)",
        f"sd AS (SELECT pts.id, mino.n_c, mino.need, row_number() OVER (PARTITION BY pts.cls ORDER BY {unit_hash('pts.id', seed)}, pts.id) - 1 "
        "AS r FROM pts JOIN mino USING (cls))",
        "jobs AS (SELECT id, unnest(range(0, CAST(need // n_c AS BIGINT) + CASE WHEN r < need % n_c THEN 1 ELSE 0 END)) AS j FROM sd)",
        f"picked AS (SELECT jobs.id, j, nn_id, {unit_hash("jobs.id || '|' || CAST(j AS VARCHAR)", seed)} AS lam FROM jobs JOIN nnn USING (id) "
        f"JOIN nn ON nn.id = jobs.id AND nn.nn_rank = ('0x' || substr(md5(jobs.id || '|' || CAST(j AS VARCHAR) || '|nn{seed}'), 1, 8))::BIGINT % n_nn)",
        "made AS (SELECT id, j, nn_id, lam, term, sum(w) AS w FROM (SELECT p.*, term, w * (1 - lam) AS w FROM picked p JOIN x ON x.id = p.id "
        "UNION ALL SELECT p.*, term, w * lam FROM picked p JOIN x ON x.id = p.nn_id) GROUP BY ALL)",
    ) + ("SELECT id || '_s' || CAST(j AS VARCHAR) AS new_id, id AS src_id, nn_id, round(lam, 9) AS lam, count(*) AS n_terms, "
         "round(sum(w), 6) AS w_sum FROM made WHERE w > 0 GROUP BY id, j, nn_id, lam")


def nb_grid_sql(alphas=(1.0, 0.1, 0.01, 0.001, 0.0001), k: int = 5, seed: int = 37) -> str:
    al = ", ".join(repr(float(a)) for a in alphas)
    return (
        "tr AS (SELECT doc_id, y AS label FROM sp WHERE split = 'train'),\n"
        f"fo AS (SELECT doc_id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {unit_hash('doc_id', seed)}, doc_id) - 1) % {k} AS INTEGER) AS fold FROM tr),\n"
        f"al AS (SELECT unnest([{al}]::DOUBLE[]) AS alpha),\n"
        f"fl AS (SELECT CAST(unnest(range(0, {k})) AS INTEGER) AS f),\n"
        "cntf AS (SELECT fl.f, fo.label, feat.term, sum(feat.w) AS n_ct FROM feat JOIN fo USING (doc_id) CROSS JOIN fl "
        "WHERE fo.fold <> fl.f GROUP BY fl.f, fo.label, feat.term),\n"
        "clsf AS (SELECT fl.f, fo.label, count(*) AS n_docs FROM fo CROSS JOIN fl WHERE fo.fold <> fl.f GROUP BY fl.f, fo.label),\n"
        "totf AS (SELECT f, label, sum(n_ct) AS total FROM cntf GROUP BY f, label),\n"
        "gc2 AS (SELECT clsf.f, clsf.label, ln(n_docs / sum(n_docs) OVER (PARTITION BY clsf.f)) AS log_prior, "
        "coalesce(totf.total, 0) AS total FROM clsf LEFT JOIN totf USING (f, label)),\n"
        "thetaf AS (SELECT gc2.f, gc2.label, al.alpha, vocab.term, ln((coalesce(cntf.n_ct, 0) + al.alpha) / "
        "(gc2.total + al.alpha * (SELECT v FROM vsize))) AS lt FROM gc2 CROSS JOIN al CROSS JOIN vocab "
        "LEFT JOIN cntf ON cntf.f = gc2.f AND cntf.label = gc2.label AND cntf.term = vocab.term),\n"
        "heldsum AS (SELECT fo.doc_id, fo.fold AS f, thetaf.label, thetaf.alpha, sum(feat.w * thetaf.lt) AS s FROM fo "
        "JOIN feat USING (doc_id) JOIN thetaf ON thetaf.f = fo.fold AND thetaf.term = feat.term "
        "GROUP BY fo.doc_id, fo.fold, thetaf.label, thetaf.alpha),\n"
        "gscore AS (SELECT fo.doc_id, fo.fold AS f, gc2.label, al.alpha, gc2.log_prior + coalesce(h.s, 0) AS score FROM fo "
        "JOIN gc2 ON gc2.f = fo.fold CROSS JOIN al LEFT JOIN heldsum h ON h.doc_id = fo.doc_id AND h.label = gc2.label "
        "AND h.alpha = al.alpha),\n"
        "gbest AS (SELECT doc_id, f, alpha, label AS p FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, f, alpha "
        "ORDER BY score DESC, label) AS rn FROM gscore) WHERE rn = 1),\n"
        "gacc AS (SELECT gbest.alpha, gbest.f, avg(CASE WHEN gbest.p = fo.label THEN 1.0 ELSE 0.0 END) AS accuracy "
        "FROM gbest JOIN fo USING (doc_id) GROUP BY gbest.alpha, gbest.f)\n"
    )
