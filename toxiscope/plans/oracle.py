"""Independent SQL (DuckDB dialect) for every SQL-checkable registered query.

Written from the operator definitions, not generated from Spark plans: tokenizing,
cleaning, hashing, rebalancing, Naive Bayes and the metrics are re-stated in SQL so
a mismatch points at a real semantic difference.
"""

from __future__ import annotations

# The English stop-word list of the saved stage, in its order.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers",
    "herself", "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what",
    "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to",
    "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s",
    "t", "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll",
    "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm",
    "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've",
    "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's",
    "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's",
    "would",
]
STOP = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS) + "]"

# The cleaning and tokenizing rules, the split and the sampling seed, stated
# here on their own, so that a slip in the library's patterns shows as a difference.
WS = r"[ \t\n\x0B\f\r]"
URL_PATTERN = r"(https?://|www\.)[^ \t\n\x0B\f\r]*"
MENTION_PATTERN = r"@[a-z0-9_]+"
NON_LETTER_PATTERN = r"[^\p{L}\p{M}']+"
RETWEET_PATTERN = r" (rt )+"
SPLIT_SEED = 42
TEST_FRACTION = 0.2
SAMPLE_SEED = 2024
FOLD_SEED = 7
LABEL = "toxic"
LABELS = ["toxic", "low_quality"]
METHODS = ["weight", "oversample", "undersample"]


def unit_hash_sql(key: str, seed: int) -> str:
    """First 32 bits of md5(key ':' seed) as a number in [0, 1)."""
    return f"(('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT / 4294967296.0)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(x: str) -> str:
    y = f"lower({x})"
    y = f"regexp_replace({y}, {_q(URL_PATTERN)}, ' ', 'g')"
    y = f"regexp_replace({y}, {_q(MENTION_PATTERN)}, ' ', 'g')"
    y = f"regexp_replace({y}, {_q(NON_LETTER_PATTERN)}, ' ', 'g')"
    y = f"regexp_replace(' ' || {y} || ' ', {_q(RETWEET_PATTERN)}, ' ', 'g')"
    return f"trim({y})"


def tokenize_sql(x: str) -> str:
    low = f"lower(coalesce({x}, ''))"
    stripped = f"regexp_replace({low}, {_q(WS + '+$')}, '')"
    return (
        f"(CASE WHEN {low} = '' THEN [''] WHEN {stripped} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({stripped}, {_q(WS)}) END)"
    )


def stop_sql(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({STOP}, lower(t)))"


def digest_sql(tokens: str) -> str:
    return f"md5(array_to_string({tokens}, ' '))"


U_SPLIT = unit_hash_sql("doc_id", SPLIT_SEED)
U_SAMPLE = unit_hash_sql("doc_id", SAMPLE_SEED)
U_FOLD = unit_hash_sql("doc_id", FOLD_SEED)

TRAINING_FRAME = f"""
SELECT d.doc_id, {clean_sql('d.text')} AS clean_comment,
       CAST(l.toxic AS INTEGER) AS toxic, CAST(1 - l.quality AS INTEGER) AS low_quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE l.toxic IS NOT NULL OR l.quality IS NOT NULL
"""

LABEL_FRAME = """
SELECT doc_id, CAST(toxic AS INTEGER) AS toxic, CAST(1 - quality AS INTEGER) AS low_quality FROM labels
"""

DOC_TOKENS = f"""
SELECT doc_id, {stop_sql(tokenize_sql(clean_sql('text')))} AS tokens FROM documents
"""

# training frame + tokens + split number
LABELLED = f"""
SELECT tf.*, {stop_sql(tokenize_sql('clean_comment'))} AS tokens, {U_SPLIT} AS u
FROM ({TRAINING_FRAME}) tf
"""


def _ctes(**named: str) -> str:
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in named.items())


def _weight_sql(method: str, y: str) -> str:
    """Row weight of a rebalancing method, given a joined counts row ``n, pos``."""
    if method == "weight":
        return f"CASE WHEN {y} = 1 THEN (n - pos)::DOUBLE / n ELSE 1.0 - (n - pos)::DOUBLE / n END"
    if method == "oversample":
        q = "((n - pos)::DOUBLE / pos)"
        return (
            f"(CASE WHEN {y} = 1 THEN greatest(floor({q}) + CASE WHEN {U_SAMPLE} < ({q} - floor({q})) "
            f"THEN 1 ELSE 0 END, 1) ELSE 1 END)::DOUBLE"
        )
    if method == "undersample":
        return (
            f"(CASE WHEN {y} = 1 OR {U_SAMPLE} < least(1.0, pos::DOUBLE / (n - pos)) THEN 1.0 ELSE 0.0 END)"
        )
    raise ValueError(method)


def _nb_sql(runs: list[tuple[str, str]]) -> str:
    """CTEs up to per-run test predictions ``pred(label_name, method, doc_id, label, prediction, margin)``."""
    weighted = " UNION ALL ".join(
        f"SELECT '{lab}' AS label_name, '{m}' AS method, doc_id, {lab} AS y, tokens, "
        f"{_weight_sql(m, lab)} AS w FROM train, (SELECT count({lab}) AS n, sum({lab}) AS pos FROM train) "
        f"WHERE {lab} IS NOT NULL"
        for lab, m in runs
    )
    test_rows = " UNION ALL ".join(
        f"SELECT '{lab}' AS label_name, '{m}' AS method, doc_id, {lab} AS y, tokens FROM test" for lab, m in runs
    )
    return _ctes(
        lab=LABELLED,
        train=f"SELECT * FROM lab WHERE u >= {TEST_FRACTION}",
        test=f"SELECT * FROM lab WHERE u < {TEST_FRACTION}",
        w=weighted,
        tok="SELECT label_name, method, y, w, unnest(tokens) AS term FROM w",
        terms="""SELECT label_name, method, term,
                  sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS s0, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS s1
                 FROM tok GROUP BY label_name, method, term""",
        tot="""SELECT label_name, method, count(*) AS V, sum(s0) AS S0, sum(s1) AS S1
               FROM terms GROUP BY label_name, method""",
        lt="""SELECT t.label_name, t.method, t.term,
                     ln(t.s0 + 1) - ln(o.S0 + o.V) AS lt0, ln(t.s1 + 1) - ln(o.S1 + o.V) AS lt1
              FROM terms t JOIN tot o ON t.label_name = o.label_name AND t.method = o.method""",
        pri="""SELECT label_name, method, ln(W0 + 1) - ln(W0 + W1 + 2) AS lp0, ln(W1 + 1) - ln(W0 + W1 + 2) AS lp1
               FROM (SELECT label_name, method, sum(CASE WHEN y = 0 THEN w ELSE 0 END) AS W0,
                            sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS W1 FROM w GROUP BY label_name, method)""",
        tt=f"""SELECT label_name, method, doc_id, y,
                      unnest(CASE WHEN len(tokens) = 0 THEN [NULL]::VARCHAR[] ELSE tokens END) AS term
               FROM ({test_rows})""",
        sc="""SELECT tt.label_name, tt.method, tt.doc_id, tt.y,
                     sum(coalesce(lt.lt0, 0)) AS d0, sum(coalesce(lt.lt1, 0)) AS d1
              FROM tt LEFT JOIN lt ON tt.label_name = lt.label_name AND tt.method = lt.method AND tt.term = lt.term
              GROUP BY tt.label_name, tt.method, tt.doc_id, tt.y""",
        pred="""SELECT sc.label_name, sc.method, sc.doc_id, sc.y AS label,
                       (sc.d1 + p.lp1) - (sc.d0 + p.lp0) AS margin,
                       CASE WHEN (sc.d1 + p.lp1) - (sc.d0 + p.lp0) > 0 THEN 1 ELSE 0 END AS prediction
                FROM sc JOIN pri p ON sc.label_name = p.label_name AND sc.method = p.method""",
        counts="""SELECT label_name, method,
                    sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END)::BIGINT AS tn,
                    sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
                    sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END)::BIGINT AS fn,
                    sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS tp
                  FROM pred GROUP BY label_name, method""",
        wide=_metrics_wide_sql("counts"),
    )


def _class_metric_sql(tp: str, fp: str, fn: str, tn: str) -> dict[str, str]:
    prec = f"(CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE {tp}::DOUBLE / ({tp} + {fp}) END)"
    rec = f"(CASE WHEN {tp} + {fn} = 0 THEN NULL ELSE {tp}::DOUBLE / ({tp} + {fn}) END)"
    f1 = f"(CASE WHEN {prec} + {rec} = 0 THEN 0.0 ELSE 2 * {prec} * {rec} / ({prec} + {rec}) END)"
    fpr = f"(CASE WHEN {fp} + {tn} = 0 THEN NULL ELSE {fp}::DOUBLE / ({fp} + {tn}) END)"
    present = f"({tp} + {fn} > 0)"
    return {k: f"(CASE WHEN {present} THEN {v} ELSE NULL END)" for k, v in
            {"precision": prec, "recall": rec, "f1": f1, "TPR": rec, "FPR": fpr}.items()}


def _metrics_wide_sql(counts: str) -> str:
    c1 = _class_metric_sql("tp", "fp", "fn", "tn")
    c0 = _class_metric_sql("tn", "fn", "fp", "tp")
    cols = ["label_name", "method", "CASE WHEN tn+fp+fn+tp = 0 THEN NULL ELSE (tp + tn)::DOUBLE / (tn+fp+fn+tp) END AS acc"]
    for name in ("precision", "recall", "f1", "TPR", "FPR"):
        cols += [f"{c0[name]} AS {name}_0", f"{c1[name]} AS {name}_1"]
    wf1 = f"(coalesce((tn + fp) * {c0['f1']}, 0) + coalesce((tp + fn) * {c1['f1']}, 0))"
    cols.append(f"CASE WHEN tn+fp+fn+tp = 0 THEN NULL ELSE {wf1} / (tn+fp+fn+tp) END AS weighted_f1")
    return f"SELECT {', '.join(cols)} FROM {counts}"


def _long_metrics_sql(wide: str) -> str:
    parts = [f"SELECT label_name, method, NULL::INTEGER AS class, 'acc' AS metric, round(acc, 6) AS value FROM {wide}"]
    for name in ("precision", "recall", "f1", "TPR", "FPR"):
        for c in (0, 1):
            parts.append(
                f"SELECT label_name, method, {c} AS class, '{name}' AS metric, round({name}_{c}, 6) AS value FROM {wide}"
            )
    return " UNION ALL ".join(parts)


MAIN_RUN = [(LABEL, "weight")]
ALL_RUNS = [(lab, m) for lab in LABELS for m in METHODS]


def _score_multilabel_sql() -> str:
    """The NB of both labels, applied to the conversation turns."""
    messages = " UNION ALL ".join(
        f"SELECT '{lab}' AS label_name, message_id, tokens FROM msg" for lab in LABELS
    )
    return _nb_sql([(lab, "weight") for lab in LABELS]) + f""",
      msg AS (SELECT conv_id || ':' || turn AS message_id, {stop_sql(tokenize_sql(clean_sql('text')))} AS tokens FROM conversations),
      mt AS (SELECT label_name, message_id,
                    unnest(CASE WHEN len(tokens) = 0 THEN [NULL]::VARCHAR[] ELSE tokens END) AS term FROM ({messages})),
      ms AS (SELECT mt.label_name, message_id, sum(coalesce(lt0, 0)) AS d0, sum(coalesce(lt1, 0)) AS d1
             FROM mt LEFT JOIN lt ON mt.label_name = lt.label_name AND mt.term = lt.term GROUP BY mt.label_name, message_id),
      mm AS (SELECT ms.label_name, message_id, (d1 + lp1) - (d0 + lp0) AS margin
             FROM ms JOIN pri ON ms.label_name = pri.label_name)
    SELECT message_id, label_name AS label, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction,
           round(1 / (1 + exp(-margin)), 4) AS probability FROM mm"""


def oracle_queries() -> dict[str, str]:
    nb1 = _nb_sql(MAIN_RUN)
    nb_all = _nb_sql(ALL_RUNS)
    train_labels = f"SELECT doc_id, {LABEL} FROM ({LABEL_FRAME}) WHERE {U_SPLIT} >= {TEST_FRACTION}"
    counts = f"(SELECT count(*) AS n, sum({LABEL}) AS pos FROM tl)"
    q = {
        "training_frame": TRAINING_FRAME,
        "clean_text": f"SELECT doc_id, {clean_sql('text')} AS clean_comment FROM documents",
        "tokenize": f"""SELECT doc_id, len(toks)::BIGINT AS n_tokens, {digest_sql('toks')} AS tokens_md5
                        FROM (SELECT doc_id, {tokenize_sql('text')} AS toks FROM documents)""",
        "stopwords": f"""SELECT doc_id, len(k)::BIGINT AS n_kept, {digest_sql('k')} AS kept_md5
                         FROM (SELECT doc_id, {stop_sql(tokenize_sql('text'))} AS k FROM documents)""",
        "term_counts": f"""SELECT doc_id, term, count(*)::BIGINT AS tf
                           FROM (SELECT doc_id, unnest(tokens) AS term FROM ({DOC_TOKENS})) GROUP BY doc_id, term""",
        "vocabulary": f"""SELECT term, doc_freq, term_count,
                                 (row_number() OVER (ORDER BY term_count DESC, term ASC) - 1)::BIGINT AS term_index
                          FROM (SELECT term, count(*)::BIGINT AS doc_freq, sum(tf)::BIGINT AS term_count
                                FROM (SELECT doc_id, term, count(*) AS tf
                                      FROM (SELECT doc_id, unnest(tokens) AS term FROM ({DOC_TOKENS}))
                                      GROUP BY doc_id, term)
                                GROUP BY term)""",
        "term_vectors": f"""{_ctes(tc=f"SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM ({DOC_TOKENS})) GROUP BY doc_id, term",
                                   vocab="SELECT term, (row_number() OVER (ORDER BY sum(tf) DESC, term ASC) - 1)::BIGINT AS term_index FROM tc GROUP BY term")}
                     SELECT tc.doc_id, vocab.term_index, tc.tf FROM tc JOIN vocab ON tc.term = vocab.term""",
        "tfidf": f"""{_ctes(tc=f"SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM ({DOC_TOKENS})) GROUP BY doc_id, term",
                            dfq="SELECT term, count(*) AS doc_freq FROM tc GROUP BY term",
                            nd="SELECT count(*) AS n FROM documents")}
                     SELECT tc.doc_id, tc.term, tc.tf,
                            round(ln((nd.n + 1)::DOUBLE / (dfq.doc_freq + 1)), 6) AS idf,
                            round(tc.tf * ln((nd.n + 1)::DOUBLE / (dfq.doc_freq + 1)), 6) AS tfidf
                     FROM tc JOIN dfq ON tc.term = dfq.term, nd""",
        "hashing_tf": f"SELECT doc_id, len(tokens)::BIGINT AS tf_sum FROM ({DOC_TOKENS})",
        "label_distribution": f"""{_ctes(tf=LABEL_FRAME)}
            SELECT label, positives, total, round(positives::DOUBLE / total, 6) AS share,
                   floor(positives::DOUBLE / total * 1000) / 10 AS pct_truncated
            FROM (SELECT 'toxic' AS label, sum(CASE WHEN toxic = 1 THEN 1 ELSE 0 END)::BIGINT AS positives,
                         count(toxic)::BIGINT AS total FROM tf
                  UNION ALL
                  SELECT 'low_quality', sum(CASE WHEN low_quality = 1 THEN 1 ELSE 0 END)::BIGINT, count(low_quality)::BIGINT FROM tf)""",
        "tagged_share": f"""SELECT tagged, total, round(tagged::DOUBLE / total, 6) AS share
            FROM (SELECT sum(CASE WHEN greatest(toxic, low_quality) = 1 THEN 1 ELSE 0 END)::BIGINT AS tagged,
                         count(*)::BIGINT AS total FROM ({LABEL_FRAME}))""",
        "label_correlation": f"""SELECT 'toxic' AS label_a, 'low_quality' AS label_b,
                   CASE WHEN isnan(c) THEN NULL ELSE round(c, 6) END AS corr
            FROM (SELECT corr(toxic::DOUBLE, low_quality::DOUBLE) AS c FROM ({LABEL_FRAME}))""",
        "hash_split": f"""SELECT doc_id, {U_SPLIT} AS split_u, {U_SPLIT} < {TEST_FRACTION} AS is_test
                          FROM ({LABEL_FRAME})""",
        "grid_points": f"""
            SELECT m.model, r.reg_param, e.elastic_net_param, (SELECT count({LABEL}) FROM ({train_labels})) AS train_rows,
                   CAST(CASE WHEN m.model = 'lr' THEN 5 ELSE 3 END AS INTEGER) AS folds
            FROM (VALUES ('lr'), ('svm')) m(model), (VALUES (0.0001::DOUBLE), (0.001), (0.1)) r(reg_param),
                 (VALUES (0.0::DOUBLE), (0.5), (1.0), (NULL)) e(elastic_net_param)
            WHERE (m.model = 'lr') = (e.elastic_net_param IS NOT NULL)""",
        "fold_assignment": f"""
            SELECT doc_id, {LABEL}, CAST(CASE WHEN {LABEL} = 1
                THEN (row_number() OVER (PARTITION BY {LABEL} ORDER BY {U_FOLD}, doc_id) - 1) % 5
                ELSE floor({U_FOLD} * 5) END AS INTEGER) AS fold
            FROM ({train_labels})""",
        "class_weights": f"""{_ctes(tl=train_labels)}
            SELECT doc_id, {LABEL}, round({_weight_sql('weight', LABEL)}, 9) AS classWeightCol FROM tl, {counts}""",
        "oversample": f"""{_ctes(tl=train_labels)}
            SELECT doc_id, {LABEL}, unnest(range(1, CAST({_weight_sql('oversample', LABEL)} AS BIGINT) + 1)) AS copy
            FROM tl, {counts}""",
        "undersample": f"""{_ctes(tl=train_labels)}
            SELECT doc_id, {LABEL} FROM tl, {counts} WHERE {_weight_sql('undersample', LABEL)} = 1.0""",
        "nb_model": f"{nb1} SELECT term, round(lt0, 6) AS log_theta0, round(lt1, 6) AS log_theta1 FROM lt",
        "nb_predict": f"{nb1} SELECT doc_id, label, prediction, round(margin, 3) AS margin FROM pred",
        "nb_ml": f"{nb1} SELECT doc_id, label, prediction, round(margin, 3) AS margin FROM pred",
        "confusion_matrix": f"""{nb1}
            SELECT 0 AS label, 0 AS prediction, tn AS n FROM counts UNION ALL
            SELECT 0, 1, fp FROM counts UNION ALL SELECT 1, 0, fn FROM counts UNION ALL SELECT 1, 1, tp FROM counts""",
        "class_metrics": f"""{nb1}
            SELECT '{LABEL}' AS label, class, metric, value FROM ({_long_metrics_sql('wide')})""",
        "weighted_f1": f"""{nb1}
            SELECT '{LABEL}' AS label, round(weighted_f1, 6) AS weighted_f1, round(f1_1, 6) AS f1_class1 FROM wide""",
        "ranking_areas": f"""{nb1}, ranks AS (SELECT label, round(margin, 6) AS s FROM pred),
              steps AS (SELECT s, sum(label) AS p, sum(1 - label) AS n FROM ranks GROUP BY s),
              curve AS (SELECT p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM steps WINDOW w AS (ORDER BY s DESC)),
              pr AS (SELECT *, tp / (tp + fp)::DOUBLE AS prec,
                       coalesce((lag(tp) OVER v) / nullif((lag(tp + fp) OVER v), 0)::DOUBLE, tp / (tp + fp)::DOUBLE) AS last
                     FROM curve WINDOW v AS (ORDER BY tp + fp))
            SELECT '{LABEL}' AS label, sum(p)::BIGINT AS positives, sum(n)::BIGINT AS negatives,
              round((SELECT sum(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END) / count(*)
                     FROM ranks a, ranks b WHERE a.label = 1 AND b.label = 0)::DOUBLE, 6) AS auc_roc,
              round(sum(p * (prec + last) / 2) / sum(p), 6) AS auc_pr FROM pr""",
        # isotonic regression by its min-max form: the largest, over all begins, of the least share
        "calibrated_probability": f"""{nb1}, ranks AS (SELECT doc_id, label, round(margin, 6) AS s FROM pred),
              steps AS (SELECT s, sum(label) AS p, count(label) AS n, row_number() OVER (ORDER BY s) AS i
                        FROM ranks WHERE label IS NOT NULL GROUP BY s),
              sums AS (SELECT i, s, p, n, sum(p) OVER (ORDER BY i) AS tp, sum(n) OVER (ORDER BY i) AS tn FROM steps),
              least AS (SELECT k.i, min((k.tp - j.tp + j.p) / (k.tn - j.tn + j.n)::DOUBLE)
                                      OVER (PARTITION BY j.i ORDER BY k.i DESC) AS share
                        FROM sums j JOIN sums k ON j.i <= k.i),
              fitted AS (SELECT i, max(share) AS probability FROM least GROUP BY i)
            SELECT doc_id, label, round(probability, 6) AS probability
            FROM ranks LEFT JOIN steps ON ranks.s = steps.s LEFT JOIN fitted ON steps.i = fitted.i""",
        "method_metrics": f"""{nb_all}
            SELECT label_name AS label, method, class, metric, value FROM ({_long_metrics_sql('wide')})""",
        "best_model": f"""{nb_all}
            SELECT label, model, method, f1, precision, recall, accuracy FROM (
              SELECT label_name AS label, 'naive_bayes' AS model, method, round(f1_1, 6) AS f1,
                     round(precision_1, 6) AS precision, round(recall_1, 6) AS recall, round(acc, 6) AS accuracy,
                     row_number() OVER (PARTITION BY label_name ORDER BY round(f1_1, 6) DESC NULLS LAST, method) AS rk
              FROM wide) WHERE rk = 1""",
    }
    test_rows = f"FROM ({LABELLED}) WHERE u < {TEST_FRACTION} AND {LABEL} IS NOT NULL"
    q |= {
        "metrics_text": f"""{nb1}, m AS ({_long_metrics_sql('wide')}),
              t AS (SELECT class, metric, coalesce(printf('%.6f', value), 'NaN') AS v FROM m)
            SELECT '{LABEL}' AS label, metric, string_agg(v, ' | ' ORDER BY class) AS text FROM t GROUP BY metric""",
        # identity checks: the rows in SQL, that every row's check holds, and that LR and SVM are at a minimum
        "lr_cv": f"SELECT doc_id, {LABEL} AS label, TRUE AS consistent, 0.0::DOUBLE AS violation {test_rows}",
        "svm_cv": f"SELECT doc_id, {LABEL} AS label, TRUE AS consistent, 0.0::DOUBLE AS violation {test_rows}",
        "mlp_word2vec": f"SELECT doc_id, {LABEL} AS label, TRUE AS consistent {test_rows}",
        "mlp_weighted": " UNION ALL ".join(
            f"SELECT doc_id, '{name}' AS name, {name} AS label, TRUE AS consistent "
            f"FROM ({LABELLED}) WHERE u < {TEST_FRACTION} AND {name} IS NOT NULL" for name in ("toxic", "low_quality")
        ),
        "mlp_embeddings": f"""SELECT vec_id, CAST(label AS INTEGER) AS label, TRUE AS consistent
            FROM embeddings WHERE {unit_hash_sql('vec_id', SPLIT_SEED)} < {TEST_FRACTION}""",
        "word2vec_docs": "SELECT doc_id, 100::BIGINT AS dims, 0.0::DOUBLE AS difference FROM documents",
        "stream_score": f"""SELECT l.label, count(*) AS rows, count(*) AS equal_to_batch
            FROM documents, (VALUES ('toxic'), ('low_quality')) l(label) GROUP BY l.label""",
        "score_multilabel": _score_multilabel_sql(),
    }
    return q
