"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import bpe, chat, chunks, crf, forest, html, language, packing, rules, search, templates, toxicity, variants
from cadence.llm.common import in_fold, table

VOCABULARY = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "word_bpe_49k.json")


def op1_counterfactual_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held = in_fold(F.col("doc_id"), 4, 2)
    found = toxicity.classify(docs, table(spark, sf, "labels"), ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_line_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = chunks.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", F.col("n_lines").cast("long"), F.col("n_removed").cast("long"),
        F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"),
    )


def op3_template_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return templates.contaminated(docs, table(spark, sf, "benchmark")).select(
        "doc_id", "item_id", "windows", "n_windows", "n_slots", "changed"
    )


def op4_mincut_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", "n_chars")


def op5_reply_tree_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.read_back(chat.format_trees(chat.as_chains(rows.unionByName(probe))))


def op6_string_kernel_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held = in_fold(F.col("doc_id"), 4, 2)
    return language.identify(docs, ~held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_crf_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held = in_fold(F.col("doc_id"), 5, 0)
    found = crf.classify(docs, table(spark, sf, "labels"), ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted", "bad_share")


def op8_forced_boundary_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.digests(docs, VOCABULARY, without=("text",))


def op9_line_first_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rules.clean(docs).select("doc_id", *rules.COUNTS, "base_failed", "kept", "n_lines_failed", "lost_chars")


def op10_lsh_forest(spark: SparkSession, sf: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


def op11_hierarchical_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return packing.pack(docs, VOCABULARY, with_ids=False).drop("ids")


def op12_presence_mask_search(spark: SparkSession, sf: str) -> DataFrame:
    docs, items = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark")
    return search.search(docs, items)


def op13_trie_frontier_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group_variants(variants.count_words(table(spark, sf, "documents").select("doc_id", "text")))


QUERIES = {
    "op1_counterfactual_toxicity": op1_counterfactual_toxicity,
    "op2_line_chunk_dedup": op2_line_chunk_dedup,
    "op3_template_decontamination": op3_template_decontamination,
    "op4_mincut_extraction": op4_mincut_extraction,
    "op5_reply_tree_chat": op5_reply_tree_chat,
    "op6_string_kernel_language": op6_string_kernel_language,
    "op7_crf_quality": op7_crf_quality,
    "op8_forced_boundary_bpe": op8_forced_boundary_bpe,
    "op9_line_first_rules": op9_line_first_rules,
    "op10_lsh_forest": op10_lsh_forest,
    "op11_hierarchical_packing": op11_hierarchical_packing,
    "op12_presence_mask_search": op12_presence_mask_search,
    "op13_trie_frontier_variants": op13_trie_frontier_variants,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_chunk_dedup": r"""
            WITH split_ AS (
                SELECT doc_id, string_split(replace(replace(replace(text, chr(10), chr(10) || chr(1)), '. ', '. ' || chr(1)), ', ', ', ' || chr(1)), chr(1)) AS p
                FROM documents
            ), line AS (
                SELECT doc_id, len(p) AS n, generate_subscripts(p, 1) - 1 AS i, unnest(p) AS piece FROM split_
            ), trimmed AS (
                SELECT *, trim(piece, ' ' || chr(9) || chr(13) || chr(10)) AS l FROM line
            ), hashed AS (
                SELECT *, ('0x' || substr(md5(l), 1, 8))::BIGINT AS h FROM trimmed
            ), rolled AS (
                SELECT *, (lag(h) OVER w * 1000003 + h) % 2147483647 AS r, lag(l) OVER w AS above
                FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
            ), marked AS (
                SELECT *, i >= 2 AND i <= n - 2 AND r < lag(r) OVER w AND r <= lead(r) OVER w AS cut
                FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
            ), cuts AS (
                SELECT doc_id, i AS pos, above || chr(10) || l AS meet,
                    coalesce(lag(i) OVER w, 0) AS low, coalesce(lead(i) OVER w, n) AS high
                FROM marked WHERE cut WINDOW w AS (PARTITION BY doc_id ORDER BY i)
            ), firsts AS (
                SELECT *, first_value(doc_id) OVER w AS r_doc, first_value(pos) OVER w AS r_at,
                    first_value(low) OVER w AS r_low, first_value(high) OVER w AS r_high
                FROM cuts WINDOW w AS (PARTITION BY meet ORDER BY doc_id, pos)
            ), later AS (
                SELECT * FROM firsts WHERE doc_id <> r_doc OR pos <> r_at
            ), compared AS (
                SELECT c.doc_id, c.pos, a.i, a.l,
                    min(CASE WHEN b.l = a.l THEN 1 ELSE 0 END) OVER (
                        PARTITION BY c.doc_id, c.pos, a.i >= c.pos ORDER BY CASE WHEN a.i >= c.pos THEN a.i ELSE -a.i END) AS same
                FROM later c
                JOIN trimmed a ON a.doc_id = c.doc_id AND a.i >= c.low AND a.i < c.high
                LEFT JOIN trimmed b ON b.doc_id = c.r_doc AND b.i = a.i - c.pos + c.r_at AND b.i >= c.r_low AND b.i < c.r_high
            ), runs AS (
                SELECT doc_id, pos FROM compared WHERE same = 1 GROUP BY doc_id, pos HAVING sum(length(l)) >= 60
            ), gone AS (
                SELECT DISTINCT doc_id, i FROM compared JOIN runs USING (doc_id, pos) WHERE same = 1
            )
            SELECT t.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
                sum(CASE WHEN g.i IS NULL THEN length(piece) ELSE 0 END)::BIGINT AS kept_chars,
                sha256(coalesce(string_agg(piece, '' ORDER BY t.i) FILTER (g.i IS NULL), '')) AS kept_sha256
            FROM trimmed t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.i = t.i
            GROUP BY t.doc_id""",
        "op3_template_decontamination": r"""
            WITH texts AS (
                SELECT 'd' AS kind, doc_id AS id, text FROM documents WHERE text IS NOT NULL
                UNION ALL SELECT 'b', item_id, text FROM benchmark WHERE text IS NOT NULL
            ), plain AS (
                SELECT kind, id, string_split(trim(regexp_replace(text, '[^\p{L}\p{N}]+', ' ', 'g'), ' '), ' ') AS r FROM texts
            ), words AS (
                SELECT kind, id, r, list_transform(range(1, len(r) + 1), lambda i: CASE
                    WHEN regexp_matches(r[i], '^\p{Lu}') THEN '<name>' WHEN regexp_matches(r[i], '^[0-9]') THEN '<num>'
                    WHEN i > 1 AND r[i] IN ({units}) AND regexp_matches(r[i - 1], '^[0-9]') THEN '<unit>' ELSE r[i] END) AS t
                FROM plain
            ), spots AS (
                SELECT *, unnest(range(0, len(t) - size + 1)) AS pos
                FROM (SELECT *, least(len(t), 8) AS size FROM words)
            ), wins AS (
                SELECT kind, id, pos, size, t[pos + 1 : pos + size] AS template, r[pos + 1 : pos + size] AS said FROM spots
            ), items AS (
                SELECT id AS item_id, pos AS item_pos, size, template, said AS fillers, count(*) OVER (PARTITION BY id) AS n_windows
                FROM wins WHERE kind = 'b' AND len(list_filter(template, lambda w: w NOT IN ('<name>', '<num>', '<unit>', ''))) >= 4
            ), hits AS (
                SELECT w.id AS doc_id, i.item_id, i.n_windows, w.pos - i.item_pos AS shift, i.item_pos, i.template, i.fillers, w.said
                FROM wins w JOIN items i ON w.template = i.template WHERE w.kind = 'd'
            ), fills AS (
                SELECT DISTINCT doc_id, item_id, shift, template, fillers, said FROM (
                    SELECT doc_id, item_id, shift, unnest(template) AS template, unnest(fillers) AS fillers, unnest(said) AS said FROM hits)
                WHERE template IN ('<name>', '<num>', '<unit>', '')
            ), fits AS (
                SELECT doc_id, item_id, shift FROM (SELECT DISTINCT doc_id, item_id, shift FROM hits)
                EXCEPT
                SELECT doc_id, item_id, shift FROM fills GROUP BY ALL
                HAVING count(*) <> count(DISTINCT (template, fillers)) OR count(*) <> count(DISTINCT (template, said))
            ), cover AS (
                SELECT doc_id, item_id, n_windows, count(DISTINCT item_pos) AS windows
                FROM hits JOIN fits USING (doc_id, item_id, shift) GROUP BY ALL
            ), slots AS (
                SELECT doc_id, item_id, count(DISTINCT (template, fillers, said)) AS n_slots,
                    count(DISTINCT (template, fillers, said)) FILTER (fillers <> said) AS changed
                FROM fills JOIN fits USING (doc_id, item_id, shift) GROUP BY ALL
            )
            SELECT doc_id, item_id, windows, n_windows, coalesce(n_slots, 0) AS n_slots, coalesce(changed, 0) AS changed
            FROM cover LEFT JOIN slots USING (doc_id, item_id) WHERE windows >= 0.5 * n_windows""".replace(
            "{units}", ", ".join(f"'{u}'" for u in templates.UNITS)
        ),
        "op5_reply_tree_chat": r"""
            WITH rows_ AS (
                SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
                UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
            ), sized AS (
                SELECT *,
                    length(text)
                    + (length(text) - length(replace(text, '\', '')))
                    + len(regexp_extract_all(text, '<\||<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>'))
                    + length(role) + 8 + 8 + 7 + 1 AS size
                FROM rows_
            )
            SELECT conv_id, count(*) AS n_turns,
                sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
                coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
                sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
                sum(size)::BIGINT AS formatted_chars
            FROM sized GROUP BY conv_id""",
        "op9_line_first_rules": _rules_sql(),
        "op10_lsh_forest": r"""
            WITH RECURSIVE words AS (
                SELECT doc_id, regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
                FROM documents
            ), shingles AS (
                SELECT DISTINCT doc_id, w[k : k + 4] AS g
                FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM words WHERE len(w) > 0)
            ), sizes AS (
                SELECT doc_id, count(g) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
            ), shared AS (
                SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_
                FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
            ), links AS (
                SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                WHERE 100 * both_ >= 85 * (x.n + y.n - both_)
            ), reach AS (
                SELECT doc_id AS a, doc_id AS b FROM sizes
                UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
            )
            SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
            FROM sizes JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) USING (doc_id)""",
        "op12_presence_mask_search": r"""
            WITH found AS (
                SELECT doc_id, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
            ), corpus AS (
                SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM found WHERE len(t) > 0
            ), asked AS (
                SELECT DISTINCT item_id, unnest(regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
            ), counted AS (
                SELECT doc_id, len(t) AS n, unnest(t) AS term FROM found
            ), tf AS (
                SELECT doc_id, n, term, count(*) AS tf FROM counted WHERE term IN (SELECT term FROM asked) GROUP BY ALL
            ), weighed AS (
                SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
                FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus
            ), scored AS (
                SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
                FROM asked JOIN tf USING (term) JOIN weighed USING (term), corpus GROUP BY ALL
            )
            SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
            FROM scored WHERE score > 0 QUALIFY rank <= 50""".replace("{lower}", _LOWER),
        "op13_trie_frontier_variants": r"""
            WITH RECURSIVE crc AS (
                SELECT list_transform(range(256), lambda b: list_reduce(
                    list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t
            ), runs AS (
                SELECT doc_id, r, count(*) AS k
                FROM (SELECT doc_id, unnest(regexp_extract_all({lower}, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents)
                WHERE length(r) >= 5 GROUP BY ALL
            ), named AS (
                SELECT *, hex(encode(doc_id || ':' || r)) AS x FROM runs
            ), coded AS (
                SELECT r, k, xor(4294967295, list_reduce(
                    list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
                FROM named, crc
            ), words AS (
                SELECT word, sum(k)::BIGINT AS n FROM (
                    SELECT k, CASE WHEN h % 97 = 0 THEN left(r, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM coded)
                WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
            ), spots AS (
                SELECT word, unnest(range(length(word))) AS i FROM words
            ), cut AS (
                SELECT DISTINCT word, i, left(word, i) || chr(1) || substr(word, i + 2) AS hole, left(word, i) || substr(word, i + 2) AS less FROM spots
            ), near AS (
                SELECT a.word, b.word AS other FROM cut a JOIN cut b USING (hole) WHERE a.word <> b.word
                UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.less
                UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.less
            ), best AS (
                SELECT near.word, other, o.n AS other_n, count(*) OVER (PARTITION BY near.word) AS n_near
                FROM near JOIN words o ON o.word = other
                QUALIFY row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, other) = 1
            ), judged AS (
                SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, other_n >= 2 * w.n AS is_form, other, other_n FROM words w LEFT JOIN best USING (word)
            ), forms AS (
                SELECT word, CASE WHEN is_form THEN other END AS form, n, n_near, CASE WHEN is_form THEN other_n END AS form_n FROM judged
            ), walk AS (
                SELECT word, word AS at FROM forms
                UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.at WHERE f.form IS NOT NULL
            )
            SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
            FROM forms f JOIN walk w USING (word) JOIN forms g ON g.word = w.at WHERE g.form IS NULL""".replace("{lower}", _LOWER),
    }


#: A text with A-Z only in lower case.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules_sql() -> str:
    limits = {k: str(getattr(rules, k)) for k in (
        "SYMBOLS_A_WORD", "SHOUTS_A_WORD", "UPPER_SHARE", "REPEAT_SHARE", "PIPES", "SHORT_WORDS", "LEAST_WORDS", "MOST_REPEATED", "MAX_LOST",
    )}
    sql = r"""
            WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
            line AS (
                SELECT doc_id, i, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') AS w FROM (
                    SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM docs)
            ), counted AS (
                SELECT *, len(w) AS n, greatest(len(w), 1) AS n1, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS seen,
                    len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols, len(regexp_extract_all(l, '!')) AS shouts,
                    len(regexp_extract_all(l, '[|]')) AS pipes, len(regexp_extract_all(l, '\p{Lu}')) AS upper_,
                    len(regexp_extract_all(l, '\p{L}')) AS letters,
                    len(list_filter(range(1, len(w)), lambda k: w[k] = w[k + 1])) AS again
                FROM line
            ), judged AS (
                SELECT *, n > 0 AND (symbols / n1 > {SYMBOLS_A_WORD} OR shouts / n1 > {SHOUTS_A_WORD}
                    OR (n >= 3 AND upper_ > {UPPER_SHARE} * greatest(letters, 1)) OR pipes >= {PIPES}
                    OR (n >= 6 AND again / n1 > {REPEAT_SHARE})
                    OR (n <= {SHORT_WORDS} AND regexp_matches(lower(l), '{phrases}'))) AS fails
                FROM counted
            ), summed AS (
                SELECT doc_id, sum(n)::BIGINT AS n_words, sum(seen)::BIGINT AS word_chars, sum(symbols)::BIGINT AS n_symbols,
                    (count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0))::BIGINT AS n_dup_lines,
                    count(*) FILTER (fails) AS n_lines_failed, coalesce(sum(seen) FILTER (fails), 0)::BIGINT AS lost_chars
                FROM judged GROUP BY doc_id
            ), words AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
            ), windows AS (
                SELECT doc_id, k, w[k : k + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM words)
            ), repeated AS (
                SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows
            ), covered AS (
                SELECT doc_id, count(DISTINCT k + d) AS n_repeat_words FROM repeated, range(5) t(d) WHERE c > 1 GROUP BY doc_id
            ), joined AS (
                SELECT s.*, coalesce(n_repeat_words, 0) AS n_repeat_words,
                    n_words < {LEAST_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MOST_REPEATED} * n_words AS base_failed
                FROM summed s LEFT JOIN covered USING (doc_id)
            )
            SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                NOT base_failed AND lost_chars <= {MAX_LOST} * word_chars AS kept, n_lines_failed, lost_chars
            FROM joined"""
    for name, value in (limits | {"phrases": "|".join(rules.PHRASES)}).items():
        sql = sql.replace("{" + name + "}", value)
    return sql
