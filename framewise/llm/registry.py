"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewise.llm.chat import link_tools
from framewise.llm.exact_dedup import exact_duplicates
from framewise.llm.fingerprints import compare_edits
from framewise.llm.licenses import PHRASES, RULES, SENTENCES, SPDX_NAMES, listed, normal, scan_licenses
from framewise.llm.line_dedup import drop_shared_lines
from framewise.llm.mixing import TOKEN, mix_sources
from framewise.llm.near_dedup import near_duplicates
from framewise.llm.negatives import hard_negatives
from framewise.llm.packing import pack
from framewise.llm.token_counts import count_tokens
from framewise.llm.topk import top_products
from framewise.llm.toxicity import score_toxicity, train
from framewise.llm.whitening import fit_whitening, whiten

END_ID = 1


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), byte_vocabulary(), END_ID)


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)


def op3_line_dedup(spark, sf_dir):
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def held_out(key: str = "doc_id"):
    """Rows that no label may be learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def toxicity_model(spark, sf_dir):
    return train(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ~held_out())


def op4_toxicity(spark, sf_dir):
    scored = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op5_exact_dedup(spark, sf_dir):
    found = exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_fingerprints(spark, sf_dir):
    return compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The flattest weights still wanted, and how often a source may be gone through.
MIX_ENTROPY, MIX_REPEATS = 0.98, 4.0


def op7_mixing(spark, sf_dir):
    mixed = mix_sources(table(spark, sf_dir, "documents"), entropy=MIX_ENTROPY, repeats=MIX_REPEATS)
    return mixed.select("doc_id", "source", "epoch", "block", "place")


def op8_licenses(spark, sf_dir):
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("license_sentences").alias("n_sentences"),
        F.array_join(F.transform("license_sentences", lambda x: F.concat(x["place"].cast("string"), F.lit(":"), x["sentence"])), " ").alias("sentences"),
        F.array_join("license_phrases", " ").alias("phrases"),
        F.array_join("license_spdx", " ").alias("spdx"),
        F.array_join("license_rules", " ").alias("rules"),
        F.array_join("licenses", " ").alias("licenses"),
    )


def op9_token_counts(spark, sf_dir):
    counted = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), byte_vocabulary())
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


TOOLS = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "lookup": {"key": ("integer", True), "exact": ("boolean", False)},
    "compute": {"values": ("array", True), "op": ("string", True)},
}


def tool_traffic(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that follow from ``conversations``, as the table itself has none.

    What a user says becomes a call that uses the result of the call before, and what the assistant
    says becomes its result. By the length of the text, some have broken or unfitting arguments,
    unknown tools, lost or circular references, and some results name other calls or come early.
    """
    turns = turns.withColumn("n", F.coalesce(F.length("text"), F.lit(0)))
    n = F.col("n")
    search = F.struct(
        F.when(n % 7 != 0, F.col("text")).alias("query"),
        F.when(n % 5 != 0, n % 9).alias("limit"),
        F.when(n % 10 == 0, F.lit(True)).alias("deep"),
    )
    lookup = F.struct(F.when(n % 4 == 0, n.cast("string")).alias("exact"), n.alias("key"))
    compute = F.struct(F.array(n, n % 10).alias("values"), F.when(n % 5 != 0, "sum").alias("op"))
    arguments = F.when(n % 13 == 0, '{"query": ').when(n % 3 == 0, F.to_json(search)).when(n % 3 == 1, F.to_json(lookup)).otherwise(F.to_json(compute))
    tool = F.when(n % 11 == 0, "paint").when(n % 3 == 0, "search").when(n % 3 == 1, "lookup").otherwise("compute")
    named = lambda turn: F.concat(F.lit("c"), turn.cast("string"))
    after = (
        F.when(n % 17 == 0, "c-1").when(n % 19 == 0, named(F.col("turn"))).when(F.col("turn") >= 2, named(F.col("turn") - 2))
    )
    calls = turns.where("role = 'user'").select(
        "conv_id", named(F.col("turn")).alias("call_id"), "turn", tool.alias("tool"), arguments.alias("arguments"), after.alias("after")
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id",
        F.when(n % 23 == 0, named(F.col("turn") + 1000)).otherwise(named(F.col("turn") - 1)).alias("call_id"),
        F.when(n % 29 == 0, F.col("turn") - 2).otherwise(F.col("turn")).alias("turn"),
        F.col("text").alias("content"),
    )
    return calls, results


def op10_tool_calls(spark, sf_dir):
    calls, results = tool_traffic(table(spark, sf_dir, "conversations"))
    linked = link_tools(calls, results, TOOLS)
    # Where there is no call: -1, not valid, no error.
    return linked.withColumns({"depth": F.coalesce("depth", F.lit(-1)), "valid": F.coalesce("valid", F.lit(False)), "errors": F.coalesce("errors", F.lit(""))})


def op11_top_k(spark, sf_dir):
    found = top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op12_hard_negatives(spark, sf_dir):
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 50 == 0, noisy)


def op13_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    explained = [] if model is None else model.explained.tolist()
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.element_at(F.lit(explained).cast("array<double>"), F.col("at") + 1).alias("explained"),
        F.lit(0.0 if model is None else model.identity_error).alias("identity_error"),
    )


def queries() -> dict:
    return {
        "op1_packing": op1_packing,
        "op2_near_dedup": op2_near_dedup,
        "op3_line_dedup": op3_line_dedup,
        "op4_toxicity": op4_toxicity,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_fingerprints": op6_fingerprints,
        "op7_mixing": op7_mixing,
        "op8_licenses": op8_licenses,
        "op9_token_counts": op9_token_counts,
        "op10_tool_calls": op10_tool_calls,
        "op11_top_k": op11_top_k,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_whitening": op13_whitening,
    }


_KEY = r"translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _license_sql() -> str:
    known = ", ".join(f"('{normal(text)}', '{name}')" for name, text in sorted(SENTENCES.items()))
    rules = ", ".join(f"('{name}', '{r.licence}', '{listed(r)}', '{r.phrase or ''}', '{r.unless or ''}')" for name, r in sorted(RULES.items()))
    phrases = ", ".join(f"('{name}', [{', '.join(f"' {normal(p)} '" for p in parts)}])" for name, parts in sorted(PHRASES.items()))
    spdx = ", ".join(f"('{word}', '{name}')" for word, name in sorted(SPDX_NAMES.items()))
    wrap = r"regexp_replace({}, '(^|[^.!?:;])\r?\n[ \t]*([a-z])', '\1 \2', 'g')"
    named = r"regexp_replace(coalesce(text, ''), '(?i)(identifier:)[ \t]+', '\1', 'g')"
    return rf"""
        WITH known AS (SELECT * FROM (VALUES {known}) AS t(sentence, name)),
        rules AS (SELECT * FROM (VALUES {rules}) AS t(rule, licence, ids, phrase, other)),
        parts_of AS (SELECT * FROM (VALUES {phrases}) AS t(phrase, parts)),
        spdx_names AS (SELECT * FROM (VALUES {spdx}) AS t(word, name)),
        cut AS (SELECT doc_id, string_split(regexp_replace(regexp_replace({wrap.format(wrap.format(named))},
                  '([.!?:;])[ \t\r\n]+', '\1' || chr(1), 'g'), '\r?\n', chr(1), 'g'), chr(1)) AS parts FROM documents),
        parts AS (SELECT doc_id, unnest(range(0, len(parts))) AS place, unnest(parts) AS part FROM cut),
        found AS (SELECT doc_id, place, name FROM parts
                  JOIN known ON trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) = sentence),
        listed AS (SELECT doc_id, count(*) AS n, string_agg(place || ':' || name, ' ' ORDER BY place) AS sentences,
                     ' ' || string_agg(name, ' ' ORDER BY place) || ' ' AS ids FROM found GROUP BY doc_id),
        plain AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')) || ' ' AS words FROM documents),
        said AS (SELECT doc_id, list(phrase ORDER BY phrase) AS phrases FROM plain
                 JOIN parts_of ON len(list_filter(parts, lambda p: NOT contains(words, p))) = 0 GROUP BY doc_id),
        lines AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)spdx-license-identifier:[ \t]*([^\r\n]*)', 1)) AS line FROM documents),
        words AS (SELECT doc_id, unnest(regexp_extract_all(line, '[A-Za-z0-9][A-Za-z0-9.+-]*')) AS word FROM lines),
        told AS (SELECT DISTINCT doc_id, name FROM words JOIN spdx_names s ON lower(words.word) = s.word),
        held AS (SELECT doc_id, coalesce(ids, '') AS ids, coalesce(phrases, []) AS phrases
                 FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN said USING (doc_id)),
        matched AS (SELECT doc_id, rule, licence, r.ids FROM held h JOIN rules r ON contains(h.ids, r.ids)
                      AND (r.phrase = '' OR list_contains(phrases, r.phrase)) AND NOT list_contains(phrases, r.other)),
        longest AS (SELECT DISTINCT doc_id, rule, licence FROM matched m WHERE m.ids = '' OR NOT EXISTS (
                      SELECT 1 FROM matched o WHERE o.doc_id = m.doc_id AND o.rule <> m.rule AND contains(o.ids, m.ids))),
        named AS (SELECT doc_id, string_agg(rule, ' ' ORDER BY rule) AS rules FROM longest GROUP BY doc_id),
        licences AS (SELECT doc_id, string_agg(licence, ' ' ORDER BY licence) AS licenses
                     FROM (SELECT doc_id, licence FROM longest UNION SELECT doc_id, name FROM told) GROUP BY doc_id)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS INT) AS n_sentences, coalesce(sentences, '') AS sentences,
          coalesce(array_to_string(phrases, ' '), '') AS phrases,
          coalesce((SELECT string_agg(name, ' ' ORDER BY name) FROM told WHERE told.doc_id = d.doc_id), '') AS spdx,
          coalesce(rules, '') AS rules, coalesce(licenses, '') AS licenses
        FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN said USING (doc_id) LEFT JOIN named USING (doc_id)
          LEFT JOIN licences USING (doc_id)"""


_MIX = """
    WITH docs AS (SELECT doc_id, source, greatest(1, len(regexp_extract_all(coalesce(text, ''), '{token}'))) AS t,
                    CAST('0x' || substr(md5('0-' || doc_id), 1, 3) AS INT) AS block FROM documents),
    sources AS (SELECT source, CAST(sum(t) AS BIGINT) AS tokens FROM docs GROUP BY source),
    shares AS (SELECT *, tokens / (SELECT sum(tokens) FROM sources) AS p FROM sources),
    grid AS (SELECT part, sum(exp(part / 10000.0::DOUBLE * ln(p))) AS z, sum(exp(part / 10000.0::DOUBLE * ln(p)) * ln(p)) AS s,
               max(p) AS most, min(p) AS least, count(*) AS n
             FROM shares CROSS JOIN range(0, 10001) AS r(part) GROUP BY part),
    judged AS (SELECT part, CASE WHEN n > 1 THEN (ln(z) - part / 10000.0::DOUBLE * s / z) / ln(n) ELSE 1 END AS level,
                 exp((1 - part / 10000.0::DOUBLE) * ln(most / least)) AS times FROM grid),
    chosen AS (SELECT greatest((SELECT max(part) FROM judged WHERE level >= {entropy} - 1e-12),
                               (SELECT min(part) FROM judged WHERE times <= {repeats} + 1e-12)) / 10000.0::DOUBLE AS a),
    weights AS (SELECT source, tokens, exp(a * ln(p)) / (SELECT sum(exp(a * ln(p))) FROM shares, chosen) AS w FROM shares, chosen),
    budgets AS (SELECT source, tokens, greatest(tokens, CAST(round((SELECT max(tokens / w) FROM weights) * w) AS BIGINT)) AS budget FROM weights),
    blocks AS (SELECT source, block, CAST(sum(t) AS BIGINT) AS filled FROM docs GROUP BY source, block),
    turns AS (SELECT b.source, block, filled, tokens, budget, unnest(range(0, (budget - 1) // tokens + 1)) AS epoch
              FROM blocks b JOIN budgets g ON b.source IS NOT DISTINCT FROM g.source),
    begun AS (SELECT *, epoch * tokens + coalesce(sum(filled) OVER (PARTITION BY source, epoch
                ORDER BY md5('0-' || coalesce(source, '~') || '-' || epoch || '-' || block)
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS began FROM turns),
    drawn AS (SELECT doc_id, d.source, epoch, d.block, t, budget - began AS room, filled, began / budget AS place,
                sum(t) OVER (PARTITION BY d.source, d.block, epoch ORDER BY md5('0-' || doc_id || '-' || epoch), doc_id, t) AS upto
              FROM docs d JOIN begun b ON d.source IS NOT DISTINCT FROM b.source AND d.block = b.block WHERE began < budget)
    SELECT doc_id, source, CAST(epoch AS INT) AS epoch, block, place FROM drawn WHERE room >= filled OR upto <= room"""

_TOOL_CALLS = """
    WITH RECURSIVE turns AS (SELECT *, coalesce(length(text), 0) AS n FROM conversations),
    calls AS (
      SELECT conv_id, 'c' || turn AS call_id, turn, text, n,
        CASE WHEN n % 11 = 0 THEN 'paint' WHEN n % 3 = 0 THEN 'search' WHEN n % 3 = 1 THEN 'lookup' ELSE 'compute' END AS tool,
        CASE WHEN n % 17 = 0 THEN 'c-1' WHEN n % 19 = 0 THEN 'c' || turn WHEN turn >= 2 THEN 'c' || (turn - 2) END AS after
      FROM turns WHERE role = 'user'),
    results AS (
      SELECT conv_id, CASE WHEN n % 23 = 0 THEN 'c' || (turn + 1000) ELSE 'c' || (turn - 1) END AS call_id,
        CASE WHEN n % 29 = 0 THEN turn - 2 ELSE turn END AS turn, text
      FROM turns WHERE role = 'assistant'),
    depths AS (
      SELECT conv_id, call_id, CAST(0 AS BIGINT) AS depth FROM calls c
      WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after)
      UNION ALL
      SELECT c.conv_id, c.call_id, depth + 1 FROM depths d JOIN calls c ON c.conv_id = d.conv_id AND c.after = d.call_id),
    checked AS (
      SELECT c.*, depth, after IS NOT NULL AND NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.call_id = c.after) AS lost,
        EXISTS (SELECT 1 FROM results r WHERE r.conv_id = c.conv_id AND r.call_id = c.call_id) AS answered,
        CASE WHEN n % 13 = 0 THEN 'not an object'
             WHEN n % 11 = 0 THEN 'unknown tool'
             WHEN n % 3 = 0 THEN concat_ws('; ', CASE WHEN n % 7 = 0 OR text IS NULL THEN 'missing query' END,
                                                 CASE WHEN n % 10 = 0 THEN 'unknown deep' END)
             WHEN n % 3 = 1 THEN CASE WHEN n % 4 = 0 THEN 'exact is no boolean' ELSE '' END
             ELSE CASE WHEN n % 5 = 0 THEN 'missing op' ELSE '' END END AS errors,
        CASE WHEN n % 13 = 0 THEN '{"text":"{\\"query\\": "}'
             WHEN n % 3 = 0 THEN '{' || concat_ws(',', CASE WHEN n % 10 = 0 THEN '"deep":true' END,
               CASE WHEN n % 5 <> 0 THEN '"limit":' || n % 9 END, CASE WHEN n % 7 <> 0 THEN '"query":' || CAST(to_json(text) AS VARCHAR) END) || '}'
             WHEN n % 3 = 1 THEN '{' || concat_ws(',', CASE WHEN n % 4 = 0 THEN '"exact":"' || n || '"' END, '"key":' || n) || '}'
             ELSE '{' || concat_ws(',', CASE WHEN n % 5 <> 0 THEN '"op":"sum"' END, '"values":[' || n || ',' || n % 10 || ']') || '}' END AS arguments
      FROM calls c LEFT JOIN depths USING (conv_id, call_id))
    SELECT conv_id, call_id, 'call' AS kind, turn, coalesce(depth, -1) AS depth,
      CASE WHEN depth IS NULL THEN 'cycle' WHEN NOT answered THEN 'unanswered' WHEN lost THEN 'lost' ELSE 'linked' END AS status,
      errors = '' AS valid, errors,
      '{"role":"assistant","tool_calls":[{"function":{"arguments":' || arguments || ',"name":"' || tool || '"},"id":"' || call_id || '","type":"function"}]}' AS message
    FROM checked
    UNION ALL
    SELECT r.conv_id, r.call_id, 'result', r.turn, coalesce(c.depth, -1),
      CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN c.depth IS NULL THEN 'cycle' WHEN r.turn < c.turn THEN 'early' ELSE 'linked' END,
      coalesce(c.errors = '', false), coalesce(c.errors, ''),
      '{"content":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || ',"role":"tool","tool_call_id":"' || r.call_id || '"}'
    FROM results r LEFT JOIN checked c USING (conv_id, call_id)"""


_INTEGERS = """
    usable AS (SELECT * FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    vectors AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x FROM usable)"""

_TOP_K = f"""
    WITH {_INTEGERS},
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
               FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""

_HARD_NEGATIVES = f"""
    WITH {_INTEGERS},
    labelled AS (SELECT vec_id, x, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
                 FROM vectors WHERE label IS NOT NULL),
    scored AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
               FROM labelled a JOIN labelled c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
    positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
                  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    mined AS (SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
              FROM positives JOIN scored USING (anchor_id)
              WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM mined WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": rf"""
            WITH lines AS (
              SELECT doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
            keyed AS (SELECT doc_id, pos, line, {_KEY} AS key FROM lines),
            shared AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
                       GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
            judged AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id <> keeper, false) AS gone
                       FROM keyed k LEFT JOIN shared s ON k.key = s.key)
            SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
              sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
            FROM judged GROUP BY doc_id""",
        "op5_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op7_mixing": _MIX.format(entropy=MIX_ENTROPY, repeats=MIX_REPEATS, token=TOKEN),
        "op8_licenses": _license_sql(),
        "op10_tool_calls": _TOOL_CALLS,
        "op11_top_k": _TOP_K,
        "op12_hard_negatives": _HARD_NEGATIVES,
    }
