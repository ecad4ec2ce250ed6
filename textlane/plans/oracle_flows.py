"""Oracle SQL (DuckDB dialect) of the queries that pass through files: the files change nothing in the result."""

from __future__ import annotations

from textlane.functions.expr import WORD_PATTERN
from textlane.operators.tagger import RARE, SUFFIX
from textlane.operators.text_chain import NOUN_TAG, TAG_RULES
from textlane.plans.oracle import FEAT, LANG_SPLIT, NB_PIPE_LANG, SEED, STOP, TEST, TF, TOK, build, tickets_sql, unit_hash, with_

#: The token rule with punctuation and contractions apart, as DuckDB writes it.
_APART = (r"regexp_extract_all(regexp_replace(regexp_replace(lower(text), '([\p{L}\p{N}_])n''t([^\p{L}\p{N}_]|$)', "
          r"'\1 n''t \2', 'g'), '([\p{L}\p{N}_])(''(?:ll|re|ve|s|m|d))([^\p{L}\p{N}_]|$)', '\1 \2 \3', 'g'), "
          r"'n''t|''(?:ll|re|ve|s|m|d)|\p{N}+(?:[.,]\p{N}+)*|[\p{L}\p{N}_]+(?:-[\p{L}\p{N}_]+)*|[^ \t\n\r\f\v\p{L}\p{N}_]')")


_TYPES = (
    r"words AS (SELECT lang, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*\.?')) AS w FROM documents)",
    r"types AS (SELECT lang, lower(regexp_replace(w, '\.$', '')) AS type, count(*) AS n, sum(CASE WHEN ends_with(w, '.') THEN 1 ELSE 0 END)::BIGINT "
    "AS n_period FROM words GROUP BY ALL)",
    "shares AS (SELECT lang, sum(n_period) / sum(n) AS share FROM types GROUP BY lang)",
    "scored AS (SELECT types.*, length(replace(type, '.', '')) AS size, "
    "-2 * (n_period * ln(share) + CASE WHEN n > n_period THEN (n - n_period) * ln(1 - share) ELSE 0 END "
    "- n_period * ln(0.99) - (n - n_period) * ln(1 - 0.99)) AS ratio FROM types JOIN shares ON types.lang IS NOT DISTINCT FROM shares.lang "
    r"WHERE n_period > 0 AND regexp_matches(type, '\p{L}'))",
    "found AS (SELECT lang, type, n, n_period, ratio * exp(-size) * (length(type) - size + 1) * pow(size, -(n - n_period)::DOUBLE) AS score "
    "FROM scored)",
    "abbr AS (SELECT * FROM found WHERE round(score, 9) >= 0.3)")


def build_flows() -> dict[str, str]:
    q: dict[str, str] = {}
    q["s1_json_scan"] = build()["p_clean"]
    q["s6_model_roundtrip"] = (with_(*TOK, *TF, *FEAT) + "SELECT d.doc_id, count(term) AS n_terms, round(coalesce(sum(w), 0), 6) AS w_sum "
                               "FROM documents d LEFT JOIN feat USING (doc_id) GROUP BY d.doc_id")
    q["s11_run_log"] = (
        "WITH f AS (" + build()["flagship"] + "), "
        "m AS (UNPIVOT (SELECT split, accuracy, precision, recall, f1 FROM f) ON accuracy, precision, recall, f1 INTO NAME k VALUE v) "
        "SELECT 'flagship' AS run_id, 'metric' AS kind, split || '_' || k AS key, round(v, 6) AS metric, NULL AS setting FROM m "
        "UNION ALL SELECT 'flagship', 'param', k, NULL, s FROM (VALUES ('alpha', '1.0'), ('seed', '42'), ('test_size', '0.3')) AS p(k, s) "
        "UNION ALL SELECT 'flagship', 'param', 'n_docs', NULL, CAST(count(*) AS VARCHAR) FROM documents "
        "UNION ALL SELECT 'flagship', 'tag', 'model', NULL, 'MultinomialNB'")
    q["t2_treebank"] = (f"SELECT lang, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM "
                        f"(SELECT lang, unnest({_APART}) AS term FROM documents) GROUP BY lang")
    q["t2_abbreviations"] = with_(*_TYPES) + "SELECT lang, type, n, n_period, round(score, 6) AS score FROM abbr"
    q["t2_sentences"] = with_(
        *_TYPES,
        r"cut AS (SELECT doc_id, lang, string_split(regexp_replace(text, '([.!?])[ \t\n\r]+(\p{Lu})', '\1' || chr(30) || '\2', 'g'), chr(30)) AS ps "
        "FROM documents WHERE length(text) > 0)",
        "pieces AS (SELECT doc_id, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pos FROM cut)",
        r"ends AS (SELECT pieces.*, abbr.type IS NULL AS closed FROM pieces LEFT JOIN abbr ON abbr.lang IS NOT DISTINCT FROM pieces.lang "
        r"AND abbr.type = lower(regexp_extract(piece, '([\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*)\.\z', 1)))",
        "numbered AS (SELECT *, coalesce(sum(closed::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
        "AS no FROM ends)",
        "sent AS (SELECT doc_id, no, length(string_agg(piece, ' ' ORDER BY pos)) AS size FROM numbered GROUP BY doc_id, no)",
    ) + "SELECT doc_id, count(*) AS n_sentences, max(size) AS longest, sum(size)::BIGINT AS n_chars FROM sent GROUP BY doc_id"
    q["t3_stopword_dir"] = (with_(TOK[0]) + ", stop AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 0.5 * "
                            "(SELECT count(*) FROM documents d WHERE d.lang = tok.lang)) "
                            "SELECT lang, count(*) AS n_tokens, count(DISTINCT term) AS n_terms FROM tok "
                            "WHERE (lang, term) NOT IN (SELECT (lang, term) FROM stop) GROUP BY lang")
    shape = "CASE " + " ".join(f"WHEN regexp_matches(term, '{p}') THEN '{t}'" for p, t in TAG_RULES) + f" ELSE '{NOUN_TAG}' END"
    q["t5_hmm_model"] = with_(
        f"l AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD_PATTERN}') AS l FROM documents WHERE {unit_hash('doc_id', SEED)} >= {TEST})",
        "t AS (SELECT doc_id, unnest(l) AS term, generate_subscripts(l, 1) AS pos FROM l)",
        f"g AS (SELECT *, {shape} AS tag FROM t)",
        "p AS (SELECT coalesce(lag(tag) OVER (PARTITION BY doc_id ORDER BY pos), '') AS item, tag FROM g)",
        "c AS (SELECT term AS item, tag, count(*) AS n FROM g GROUP BY ALL)",
        f"s AS (SELECT item, tag, n, unnest(range(0, least(length(item), {SUFFIX}) + 1)) AS k FROM c "
        f"WHERE item IN (SELECT item FROM c GROUP BY item HAVING sum(n) <= {RARE}))",
    ) + ("SELECT 'pair' AS kind, item, tag, count(*) AS n FROM p GROUP BY ALL UNION ALL SELECT 'term', item, tag, n FROM c "
         "UNION ALL SELECT 'suffix', right(item, k), tag, sum(n)::BIGINT FROM s GROUP BY ALL")
    q["t5_lexicon_tags"] = (
        with_(TOK[0], f"ctok AS (SELECT * FROM tok WHERE term NOT IN ({STOP}))",
              r"lex AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM benchmark)") +
        "SELECT lang, CASE WHEN lex.term IS NOT NULL THEN 'BENCH' WHEN regexp_matches(ctok.term, '^[0-9]+([.,][0-9]+)*$') THEN 'CD' "
        "WHEN ends_with(ctok.term, 'ing') THEN 'VBG' WHEN ends_with(ctok.term, 'ed') THEN 'VBD' WHEN ends_with(ctok.term, 'ly') THEN 'RB' "
        "WHEN regexp_matches(ctok.term, '[^s]s$') THEN 'NNS' ELSE 'NN' END AS tag, count(*) AS n_tokens "
        "FROM ctok LEFT JOIN lex ON ctok.term = lex.term GROUP BY ALL")
    q["f2_tfidf_train"] = (
        with_(*TOK, TF[0], LANG_SPLIT,
              "tvocab AS (SELECT term, count(*) AS df FROM tf JOIN sp USING (doc_id) WHERE split = 'train' GROUP BY term)",
              "tn AS (SELECT count(*) AS n FROM sp WHERE split = 'train')",
              "raw AS (SELECT doc_id, term, tf, tf * (ln((1 + n) / (1 + df)) + 1) AS w0 FROM tf JOIN tvocab USING (term) CROSS JOIN tn)") +
        "SELECT doc_id, split, term, tf, round(w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY doc_id)), 6) AS w FROM raw JOIN sp USING (doc_id)")
    q["e8_registry_eval"] = (NB_PIPE_LANG + "SELECT 2::INTEGER AS version, round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
                             "FROM pj WHERE split = 'test'")
    q["r8_run_status"] = ("SELECT user_id, min(ts) AS start_ts, max(ts) AS end_ts, CASE arg_max(event_type, (ts, event_id)) WHEN 'error' "
                          "THEN 'FAILED' WHEN 'purchase' THEN 'FINISHED' ELSE 'RUNNING' END AS status FROM events GROUP BY user_id")
    return q
