"""The same results as the registered queries, as SQL over the same tables."""

from __future__ import annotations

_FILES = """
files AS (
  SELECT page_id, full_path, split_part(full_path, '/', 1) AS repo_name,
         regexp_replace(full_path, '^[^/]*/', '') AS path, size
  FROM (SELECT page_id, octet_length(encode(html)) AS size,
               regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '') AS full_path
        FROM pages)
)"""

_WORDS = """
words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^ \\n\\t\\r]+') AS w FROM documents)
)"""

_VOCAB = (
    _WORDS
    + """,
vocab AS (
  SELECT word, n, CAST(2 + row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS id
  FROM (SELECT word, count(*) AS n FROM words GROUP BY word)
  QUALIFY row_number() OVER (ORDER BY n DESC, word) <= 2000
)"""
)

_IDS = (
    _VOCAB
    + """,
encoded AS (
  SELECT doc_id, list(coalesce(id, 2) ORDER BY pos) AS ids
  FROM words LEFT JOIN vocab USING (word) GROUP BY doc_id
)"""
)

_MODEL = """
cells AS (
  SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim FROM embeddings
),
centroids AS (SELECT label AS class, dim, avg(x) AS c FROM cells GROUP BY ALL),
bias AS (SELECT class, -0.5 * sum(c * c) AS b FROM centroids GROUP BY class),
scores AS (
  SELECT vec_id, class, sum(x * c) + any_value(b) AS score
  FROM cells JOIN centroids USING (dim) JOIN bias USING (class) GROUP BY vec_id, class
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY class) - 1 AS pos,
         row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) AS rank
  FROM scores
),
best AS (SELECT vec_id, class AS predicted, pos FROM ranked WHERE rank = 1)"""


def _chunks(block: int, step: int, source: str = "documents") -> str:
    return f"""
SELECT doc_id, chunk_no, substr(text, chunk_no * {step} + 1, {block}) AS chunk
FROM (SELECT doc_id, text,
             unnest(CASE WHEN length(text) < {block} THEN [0::BIGINT]
                         ELSE range(0, (length(text) + {step} - 1) // {step}) END) AS chunk_no
      FROM {source})"""


_PAGE_GLOB = r"'^(m\.[^/]*/.*|[^/]*/fr/[^/]*|www\.[^/]*/en/[0-4][^/]*)$'"

ORACLES: dict[str, str] = {
    "scan_csv_skip_bad": """
SELECT doc_id, source, lang, text, CASE WHEN lang = 'fr' THEN NULL ELSE n_chars END AS n_chars
FROM documents WHERE lang <> 'de'""",
    "corpus_manifest": f"""
WITH {_FILES}
SELECT DISTINCT repo_name, path,
       'https://repos.example/' || repo_name || '/blob/' || md5(repo_name) || '/' || path AS blob_url
FROM files
WHERE size > 0
  AND (split_part(path, '/', -1) LIKE '%.html' OR split_part(path, '/', -1) LIKE '%/')
  AND (split_part(path, '/', -1) = '8.html'
       OR NOT (split_part(path, '/', -1) IN ('25', '328.html') OR regexp_matches(path, '^fr/[^/]*$')))""",
    "scan_text_tree": """
SELECT source || '/_' || doc_id || '.txt' AS path,
       replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text
FROM documents""",
    "parse_json_defaults": """
SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), 0) AS k,
       coalesce(json_extract_string(props, '$.unit'), 'ms') AS unit,
       CAST(json_extract(props, '$.limits.low') AS INTEGER) AS low
FROM events""",
    "corpus_file_inventory": f"""
WITH {_FILES}
SELECT CASE WHEN contains(full_path, '/') THEN regexp_replace(full_path, '/[^/]*$', '') ELSE '' END AS repo,
       full_path AS file
FROM files WHERE full_path NOT LIKE '%/'""",
    "write_corpus": """
SELECT source AS repo_name, lang || '-' || n_chars || '.txt' AS file_name, doc_id, text
FROM documents
QUALIFY row_number() OVER (PARTITION BY source, lang, n_chars ORDER BY doc_id DESC) = 1""",
    "write_metadata": f"""
WITH {_FILES}
SELECT repo_name, path,
       CASE WHEN replace(path, '/', '-') LIKE '%.html' THEN replace(path[:-6], '/', '-') ELSE replace(path, '/', '-') END
         || '.metadata.json' AS file_name,
       'https://repos.example/' || repo_name || '/blob/' || md5(repo_name) || '/' || path AS github_url
FROM files""",
    "write_deduped": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
    "corpus_card": f"""
WITH {_FILES}, listed AS (SELECT * FROM files WHERE full_path NOT LIKE '%/')
SELECT 'repo' AS section,
       CASE WHEN contains(full_path, '/') THEN regexp_replace(full_path, '/[^/]*$', '') ELSE '' END AS key,
       count(*) AS n
FROM listed GROUP BY ALL
UNION ALL
SELECT 'extension', split_part(full_path, '.', -1), count(*) FROM listed GROUP BY ALL""",
    "drop_empty_files": "SELECT doc_id, source FROM documents WHERE length(text) > 0",
    "filter_extensions": f"""
WITH {_FILES}
SELECT page_id, full_path AS "full" FROM files
WHERE regexp_matches(split_part(full_path, '/', -1), '(\\.html|5\\.html|/)$')""",
    "include_over_exclude": f"""
WITH {_FILES}
SELECT page_id, full_path AS "full" FROM files
WHERE split_part(full_path, '/', -1) = '8.html'
   OR NOT (split_part(full_path, '/', -1) IN ('25', '328.html') OR regexp_matches(full_path, {_PAGE_GLOB}))""",
    "exclude_globs": f"""
WITH {_FILES}
SELECT page_id, full_path AS "full" FROM files WHERE NOT regexp_matches(full_path, {_PAGE_GLOB})""",
    "exclude_component": f"""
WITH {_FILES}
SELECT page_id, full_path AS "full" FROM files WHERE NOT list_contains(string_split(full_path, '/'), 'en')""",
    "repo_path_columns": f"""
WITH {_FILES}
SELECT page_id, repo_name,
       'https://repos.example/' || repo_name || '/blob/' || md5(repo_name) || '/' || path AS blob_url
FROM files""",
    "flatten_file_name": f"WITH {_FILES} SELECT page_id, replace(full_path, '/', '-') AS file_name FROM files",
    "sidecar_name": f"""
WITH {_FILES}, flat AS (SELECT page_id, replace(full_path, '/', '-') AS name FROM files)
SELECT page_id,
       CASE WHEN regexp_matches(name, '^.+\\.[^.]+$') THEN regexp_extract(name, '^(.+)\\.[^.]+$', 1) ELSE name END
         || '.metadata.json' AS file_name
FROM flat""",
    "file_extension": f"WITH {_FILES} SELECT page_id, split_part(path, '.', -1) AS extension FROM files",
    "append_eos": "SELECT doc_id, text || '</s>' AS text FROM documents",
    "elapsed_ms": """
SELECT event_id, ms AS elapsed_ms, printf('%.3f ms', ms) AS shown
FROM (SELECT event_id, date_diff('microsecond', date_trunc('hour', ts), ts) / 1000.0::DOUBLE AS ms FROM events)""",
    "scale_vectors": """
SELECT vec_id, 0::INTEGER AS row, CAST(unnest(range(len(embedding))) AS INTEGER) AS col,
       round(unnest(embedding)::DOUBLE / 255, 9) AS value
FROM embeddings""",
    "files_join_repos": """
SELECT doc_id, source AS repo_name, 'https://repos.example/' || source AS url, md5(source) AS sha FROM documents""",
    "anti_exclusions": """
SELECT doc_id, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)""",
    "docs_join_metadata": """
SELECT d.doc_id, d.source, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "request_fanout": """
SELECT conv_id, turn, text, CAST(r AS INTEGER) AS req_no FROM conversations, range(3) t(r)""",
    "compare_backends": f"""
WITH {_MODEL},
rough AS (
  SELECT vec_id, class, sum(round(x * 127) / 127.0::DOUBLE * c) + any_value(b) AS score
  FROM cells JOIN centroids USING (dim) JOIN bias USING (class) GROUP BY vec_id, class
),
both_scores AS (
  SELECT s.vec_id, s.score AS a, r.score AS b,
         row_number() OVER (PARTITION BY vec_id ORDER BY class) - 1 AS pos
  FROM scores s JOIN rough r USING (vec_id, class)
)
SELECT vec_id, round(max(abs(a - b)), 6) AS max_abs_diff,
       CAST(arg_max(pos, a) AS INTEGER) AS argmax_a, CAST(arg_max(pos, b) AS INTEGER) AS argmax_b,
       arg_max(pos, a) = arg_max(pos, b) AS agree
FROM both_scores GROUP BY vec_id""",
    "dedup_rows": "SELECT DISTINCT text, lang, source, n_chars FROM documents",
    "files_per_repo": "SELECT source, count(text) AS file_count FROM documents GROUP BY source",
    "extension_counts": f"""
WITH {_FILES}
SELECT split_part(path, '.', -1) AS extension, count(*) AS n FROM files GROUP BY ALL ORDER BY n DESC, extension""",
    "perplexity": """
WITH ranked AS (
  SELECT source, text, row_number() OVER (ORDER BY md5('41|' || doc_id)) AS r, count(*) OVER () AS total FROM documents
),
sides AS (SELECT source, r <= ceil(0.1 * total) AS held_out, regexp_extract_all(text, '[^ \\n\\t\\r]+') AS w FROM ranked),
tokens AS (SELECT source, held_out, unnest(w) AS word FROM sides),
model AS (SELECT word, count(*) AS n FROM tokens WHERE NOT held_out GROUP BY word),
size AS (SELECT sum(n) + count(*) + 1 AS slots FROM model)
SELECT source, count(*) AS n_tokens, round(exp(-avg(ln((coalesce(n, 0) + 1) / slots::DOUBLE))), 4) AS perplexity
FROM tokens LEFT JOIN model USING (word), size
WHERE held_out GROUP BY source""",
    "dataset_size": f"SELECT count(*) AS n_rows FROM ({_chunks(1024, 1024)})",
    "sequence_shape_profile": """
SELECT 'embedding' AS field, count(*) AS n, CAST(min(len(embedding)) AS INTEGER) AS min_len,
       CAST(max(len(embedding)) AS INTEGER) AS max_len, round(avg(len(embedding)), 6) AS avg_len
FROM embeddings
UNION ALL
SELECT 'words', count(*), CAST(min(len(w)) AS INTEGER), CAST(max(len(w)) AS INTEGER), round(avg(len(w)), 6)
FROM (SELECT regexp_extract_all(text, '[^ \\n\\t\\r]+') AS w FROM documents)""",
    "backend_timing": """
SELECT event_type AS backend, count(value) AS n, min(value) AS min_s, max(value) AS max_s,
       round(sum(value), 6) AS total_s, round(avg(value), 6) AS mean_s,
       round(quantile_cont(value, 0.5), 6) AS p50_s, round(quantile_cont(value, 0.95), 6) AS p95_s,
       round((SELECT avg(value) FROM events WHERE event_type = 'view') / avg(value), 6) AS speedup
FROM events GROUP BY event_type""",
    "name_collisions": f"""
WITH {_FILES}
SELECT repo_name, replace(full_path, '/', '-') AS file_name, count(*) AS n_files
FROM files GROUP BY ALL HAVING count(*) > 1""",
    "confusion_matrix": f"""
WITH {_MODEL}
SELECT label, predicted, count(*) AS n FROM embeddings JOIN best USING (vec_id) GROUP BY ALL""",
    "collect_group_files": """
WITH numbered AS (
  SELECT source, file, (row_number() OVER (PARTITION BY source ORDER BY file) - 1) // 20 AS part
  FROM (SELECT source, lang || '/' || doc_id || '.txt' AS file FROM documents)
)
SELECT source, part, string_agg(file, ',' ORDER BY file) AS files, count(*) AS n_files
FROM numbered GROUP BY source, part""",
    "build_vocab": f"WITH {_VOCAB} SELECT word, n, id FROM vocab",
    "dedup_keep_first": """
SELECT doc_id, text, lang, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""",
    "transcript_delta": """
SELECT conv_id, turn,
       substr(text, coalesce(lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), 0) + 1) AS delta
FROM conversations""",
    "context_tail": """
WITH turns AS (
  SELECT conv_id, turn, regexp_extract_all(text, '[^ \\n\\t\\r]+') AS w FROM conversations
),
ends AS (SELECT conv_id, turn, w, sum(len(w)) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM turns),
said AS (
  SELECT conv_id, unnest(w) AS word, upto - len(w) + unnest(range(1, len(w) + 1)) AS place FROM ends
)
SELECT e.conv_id, e.turn, coalesce(string_agg(word, ' ' ORDER BY place), '') AS context
FROM ends e LEFT JOIN said s ON s.conv_id = e.conv_id AND s.place <= e.upto AND s.place > e.upto - 32
GROUP BY e.conv_id, e.turn""",
    "batch_ids": """
SELECT doc_id, source, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch_id FROM documents""",
    "row_index": """
SELECT doc_id, source, row_number() OVER (ORDER BY source, doc_id) - 1 AS row_index FROM documents""",
    "limit_docs": _chunks(1024, 1024, "(SELECT * FROM documents ORDER BY doc_id LIMIT 5)"),
    "head_rows": "SELECT doc_id, source, lang FROM documents ORDER BY doc_id LIMIT 5",
    "first_result": """
SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
    "union_sources": """
SELECT 'documents' AS origin, text FROM documents
UNION ALL SELECT 'benchmark', text FROM benchmark
UNION ALL SELECT 'conversations', text FROM conversations""",
    "distinct_names": "SELECT DISTINCT source FROM documents",
    "train_test_split": """
SELECT doc_id, source,
       row_number() OVER (ORDER BY md5('41|' || doc_id)) <= ceil(0.01 * count(*) OVER ()) AS is_test
FROM documents""",
    "chunk_text": _chunks(1024, 128),
    "tokenize": f"WITH {_IDS} SELECT doc_id, array_to_string(ids, ' ') AS ids FROM encoded",
    "pad_truncate": f"""
WITH {_IDS}, cut AS (SELECT doc_id, ids[:128] AS ids FROM encoded)
SELECT doc_id, repeat('0 ', 128 - len(ids)) || array_to_string(ids, ' ') AS input_ids,
       repeat('0 ', 128 - len(ids)) || rtrim(repeat('1 ', len(ids))) AS attention_mask
FROM cut""",
    "batch_pad_labels": f"""
WITH {_IDS},
batched AS (SELECT doc_id, ids, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch_id FROM encoded),
wide AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) - len(ids) AS missing FROM batched)
SELECT doc_id, batch_id, array_to_string(ids, ' ') || repeat(' 0', missing) AS input_ids,
       rtrim(repeat('1 ', len(ids))) || repeat(' 0', missing) AS attention_mask,
       array_to_string(ids, ' ') || repeat(' -100', missing) AS labels
FROM wide""",
    "decode_ids": f"""
WITH {_VOCAB}
SELECT doc_id, string_agg(CASE WHEN id IS NULL THEN '<unk>' ELSE word END, ' ' ORDER BY pos) || ' </s>' AS text
FROM words LEFT JOIN vocab USING (word) GROUP BY doc_id""",
    "matrix_long": """
SELECT vec_id, CAST(i // 8 AS INTEGER) AS row, CAST(i % 8 AS INTEGER) AS col, round(x::DOUBLE, 9) AS value
FROM (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM embeddings)""",
    "clm_examples": f"""
WITH {_IDS}
SELECT doc_id, array_to_string(ids, ' ') AS ids, array_to_string(ids, ' ') AS labels FROM encoded""",
    "batch_score": f"""
WITH {_MODEL}
SELECT r.vec_id, b.predicted, CAST(r.pos AS INTEGER) AS pos, round(r.score, 6) AS score
FROM ranked r JOIN best b USING (vec_id)""",
    "best_labels": """
WITH cells AS (
  SELECT vec_id // 4 AS class, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS dim FROM embeddings
),
means AS (SELECT class, dim, avg(x) AS c FROM cells GROUP BY ALL),
model AS (SELECT class, list(c ORDER BY dim) AS c FROM means GROUP BY class),
scores AS (
  SELECT vec_id, class, list_dot_product(embedding::DOUBLE[], c) - 0.5 * list_dot_product(c, c) AS score FROM embeddings, model
)
SELECT vec_id, first(class ORDER BY score DESC, class) AS predicted, round(max(score), 6) AS best_score FROM scores GROUP BY vec_id""",
    "timed_batch_score": f"WITH {_MODEL} SELECT vec_id, 'worker' AS backend, predicted, true AS timed FROM best",
    "map_batches": _chunks(1024, 512),
    "chunk_udtf": _chunks(1024, 512),
    "stream_stamp": "SELECT event_id, event_type AS name, true AS stamped FROM events",
    "stream_delta": """
SELECT conv_id, turn,
       substr(text, coalesce(lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn), 0) + 1) AS delta
FROM conversations""",
    "metadata_prefix": """
SELECT doc_id, 'source: ' || source || chr(10) || 'lang: ' || lang || chr(10) || text AS text FROM documents""",
    "group_holdout": "SELECT doc_id, source, source IN ('src1', 'src7') AS is_test FROM documents",
    "split_leakage": """
WITH flagged AS (
  SELECT text, row_number() OVER (ORDER BY md5('41|' || doc_id)) <= ceil(0.1 * count(*) OVER ()) AS is_test FROM documents
),
lines AS (SELECT is_test, trim(unnest(string_split(text, chr(10))), ' ') AS line FROM flagged)
SELECT line, count(*) FILTER (is_test) AS n_test, count(*) FILTER (NOT is_test) AS n_train
FROM lines WHERE length(line) >= 40 GROUP BY line HAVING n_test > 0 AND n_train > 0""",
    "passage_leakage": """
WITH flagged AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \n\t\r]'), lambda w: w <> '') AS w,
         row_number() OVER (ORDER BY md5('41|' || doc_id)) <= ceil(0.1 * count(*) OVER ()) AS is_test
  FROM documents
),
runs AS (
  SELECT doc_id, is_test, i, array_to_string(w[i + 1:i + 16], ' ') AS passage
  FROM (SELECT doc_id, is_test, w, unnest(range(0, len(w) - 15)) AS i FROM flagged WHERE len(w) >= 16)
)
SELECT doc_id, count(*) AS n_passages, min(i) AS first_word
FROM runs WHERE is_test AND passage IN (SELECT passage FROM runs WHERE NOT is_test) GROUP BY doc_id""",
    "fim_transform": """
WITH picked AS (
  SELECT doc_id, text, ('0x' || md5('41|fim|' || doc_id)[1:12])::BIGINT % 1000000 < 500000 AS is_fim,
         ('0x' || md5('41|a|' || doc_id)[1:12])::BIGINT % (length(text) + 1) AS a,
         ('0x' || md5('41|b|' || doc_id)[1:12])::BIGINT % (length(text) + 1) AS b
  FROM documents
)
SELECT doc_id, is_fim, CASE WHEN is_fim
  THEN '<fim_prefix>' || substr(text, 1, least(a, b)) || '<fim_suffix>' || substr(text, greatest(a, b) + 1)
       || '<fim_middle>' || substr(text, least(a, b) + 1, greatest(a, b) - least(a, b))
  ELSE text END AS text
FROM picked""",
    "mlm_mask": f"""
WITH {_IDS},
places AS (SELECT doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS i FROM encoded),
hidden AS (
  SELECT doc_id, id, i, ('0x' || md5(md5('41|mlm|' || doc_id) || '|' || i)[1:8])::BIGINT < CAST(floor(0.15 * 4294967296) AS BIGINT) AS h FROM places
)
SELECT doc_id, string_agg(CASE WHEN h THEN -1 ELSE id END, ' ' ORDER BY i) AS input_ids,
       string_agg(CASE WHEN h THEN id ELSE -100 END, ' ' ORDER BY i) AS labels
FROM hidden GROUP BY doc_id""",
    "chunks_per_source": """
SELECT source, count(*) AS n_docs,
       CAST(sum(CASE WHEN length(text) < 1024 THEN 1 ELSE (length(text) + 1023) // 1024 END) AS BIGINT) AS n_chunks
FROM (SELECT DISTINCT text, lang, source FROM documents) GROUP BY source""",
}
