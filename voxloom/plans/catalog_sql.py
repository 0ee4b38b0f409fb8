"""The catalog's queries as SQL over the same tables, for checking results."""

from __future__ import annotations

# White space of voxloom.functions.text in RE2 spelling.
WS = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

UTTERANCES = """
utterances AS (
  SELECT doc_id, text, source AS corpus, lang AS language,
         CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'dev' ELSE 'test' END AS split,
         n_chars * 160 AS audio_size, n_chars * 160 AS num_samples,
         CASE n_chars % 50 WHEN 7 THEN NULL WHEN 9 THEN 'nan'::DOUBLE
              ELSE n_chars * 160 / 16000e0 END AS duration
  FROM documents)"""

CORPORA = f"""{UTTERANCES},
first_all AS (
  SELECT * REPLACE (CASE WHEN language = 'es' THEN 'spa_Latn' WHEN corpus = 'src7' THEN language || '_Arab'
                         ELSE language || '_Latn' END AS language), 'first' AS source
  FROM utterances),
first_corpus AS (SELECT * FROM first_all WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
second_corpus AS (
  SELECT u.* EXCLUDE (num_samples) REPLACE (CASE WHEN split = 'dev' THEN 'validation' ELSE split END AS split),
         l.quality, 'second' AS source
  FROM utterances u JOIN labels l USING (doc_id)),
both_corpora AS (SELECT * FROM first_corpus UNION ALL BY NAME SELECT * FROM second_corpus),
split_pairs AS (
  SELECT * FROM (VALUES ('first', 'train', 'train'), ('first', 'dev', 'train'), ('first', 'test', 'train'),
    ('second', 'train', 'train'), ('second', 'test', 'train'), ('second', 'validation', 'validation'))
    AS t(source, split, destination_split)),
bases AS (
  SELECT split_part(language, '_', 1) AS base, min(language) AS label FROM first_corpus GROUP BY 1),
harmonized AS (
  SELECT s.* REPLACE (coalesce(b.label, s.language) AS language), s.language AS source_language
  FROM second_corpus s LEFT JOIN bases b ON b.base = split_part(s.language, '_', 1))"""

KEEP = f"""(coalesce(regexp_matches(text, '[^{WS}]'), false)
   AND coalesce(NOT isnan(duration) AND duration >= 0.03, false))"""

AUDIO_PATH = """CASE corpus WHEN 'src3' THEN '/elsewhere/' || doc_id || '.wav' WHEN 'src4' THEN ' '
   WHEN 'src5' THEN NULL WHEN 'src6' THEN 'clips/../clips/./' || doc_id || '.wav'
   ELSE 'clips/' || doc_id || '.wav' END"""

SOURCE_FILE = "'/data/' || corpus || '/' || split || '/' || source_language || '/' || doc_id % 8 || '.parquet'"

COMPOSED = f"""{CORPORA},
sources AS (
  SELECT *, language AS source_language FROM first_corpus UNION ALL BY NAME SELECT * FROM harmonized),
inventory AS (
  SELECT CASE WHEN quality = 1 THEN '/data/' || corpus ELSE '/data' END || '/clips/' || doc_id || '.wav' AS path
  FROM utterances JOIN labels USING (doc_id)
  UNION
  SELECT '/data/' || corpus || '/' || split || '/' || language || '/clips/' || doc_id || '.wav'
  FROM utterances JOIN labels USING (doc_id) WHERE toxic = 1),
composed AS (
  SELECT s.corpus, s.split AS source_split, p.destination_split, s.source_language, s.language,
         {SOURCE_FILE.replace("corpus", "s.corpus").replace("split", "s.split").replace("source_language", "s.source_language")} AS source_file,
         {KEEP} AND (s.source = 'second' OR coalesce(num_samples >= 400, false)) AS keep,
         CASE WHEN s.corpus NOT IN ('src3', 'src4', 'src5')
               AND ('/data/' || s.corpus || '/' || s.split || '/' || s.source_language || '/clips/' || doc_id || '.wav' IN (SELECT path FROM inventory)
                 OR '/data/' || s.corpus || '/clips/' || doc_id || '.wav' IN (SELECT path FROM inventory)
                 OR '/data/clips/' || doc_id || '.wav' IN (SELECT path FROM inventory))
              THEN 1 ELSE 0 END AS resolved
  FROM sources s JOIN split_pairs p USING (source, split)),
all_files AS (
  SELECT DISTINCT corpus, split AS source_split, destination_split, source_language, language,
         {SOURCE_FILE} AS source_file
  FROM (SELECT *, language AS source_language FROM first_all UNION ALL BY NAME SELECT * FROM harmonized)
  JOIN split_pairs USING (source, split)),
per_file AS (
  SELECT corpus, source_split, destination_split, source_language, language, source_file,
         count(*) AS before, count(*) FILTER (keep) AS after, sum(resolved) AS resolved
  FROM composed GROUP BY ALL)"""

MANIFEST = f"""WITH {COMPOSED}
SELECT f.corpus, f.source_split, f.destination_split, f.source_language, f.language,
       count(*) FILTER (coalesce(c.after, 0) > 0) AS parquet_files,
       coalesce(sum(c.before), 0)::BIGINT AS rows_before, coalesce(sum(c.after), 0)::BIGINT AS rows_after,
       coalesce(sum(c.before - c.after), 0)::BIGINT AS dropped_rows,
       count(*) FILTER (coalesce(c.after, 0) = 0) AS dropped_files,
       coalesce(sum(c.resolved), 0)::BIGINT AS normalized_audio_paths
FROM all_files f LEFT JOIN per_file c USING (source_file)
GROUP BY ALL"""

NORMALIZED = f"trim(regexp_replace(lower(%s), '[{WS}]+', ' ', 'g'))"

PAIRS = f"""
pairs AS (
  SELECT a.conv_id, a.turn, a.role, {NORMALIZED % "a.text"} AS ref, {NORMALIZED % "b.text"} AS hyp
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1)"""

# Word edit distance, one anti-diagonal of the distance table per step.
WORD_SCORES = f"""{PAIRS},
tokens AS (
  SELECT conv_id, turn, role, list_filter(string_split(ref, ' '), lambda t: t <> '') AS rw,
         list_filter(string_split(hyp, ' '), lambda t: t <> '') AS hw FROM pairs),
vocabularies AS (SELECT *, list_distinct(list_concat(rw, hw)) AS v FROM tokens),
coded AS (
  SELECT conv_id, turn, role, len(rw) AS n, len(hw) AS m,
         list_transform(rw, lambda w: list_position(v, w)) AS a,
         list_transform(hw, lambda w: list_position(v, w)) AS b
  FROM vocabularies),
steps AS (
  SELECT conv_id, turn, role, n, m, a, b, 0 AS k, [0]::BIGINT[] AS last, []::BIGINT[] AS before FROM coded
  UNION ALL
  SELECT conv_id, turn, role, n, m, a, b, k + 1,
         list_transform(range(0, n + 1), lambda i:
           CASE WHEN i > k + 1 OR k + 1 - i > m THEN NULL
                WHEN i = 0 OR i = k + 1 THEN k + 1
                ELSE least(last[i] + 1, last[i + 1] + 1,
                           before[i] + CASE WHEN a[i] = b[k + 1 - i] THEN 0 ELSE 1 END) END),
         last
  FROM steps WHERE k < n + m),
word_scores AS (
  SELECT conv_id, turn, role, last[n + 1] AS word_edits, n::BIGINT AS word_total FROM steps WHERE k = n + m)"""


def char_scores(pairs: str = "pairs") -> str:
    """Character edits: each distinct character of a pair becomes one byte."""
    spelled = (
        "coalesce(list_aggregate(list_transform(string_split({x}, ''), "
        "lambda c: chr(list_position(v, c)::INTEGER)), 'string_agg', ''), '')"
    )
    return f"""
lettered AS (
  SELECT * EXCLUDE (ref, hyp), replace(ref, ' ', '') AS rc, replace(hyp, ' ', '') AS hc,
         list_distinct(string_split(replace(ref || hyp, ' ', ''), '')) AS v
  FROM {pairs}),
char_scores AS (
  SELECT * EXCLUDE (rc, hc, v), length(rc) AS char_total,
         CASE WHEN rc = '' OR hc = '' THEN length(rc) + length(hc)
              ELSE levenshtein({spelled.format(x="rc")}, {spelled.format(x="hc")}) END AS char_edits
  FROM lettered)"""


ALL_SCORES = f"""WITH RECURSIVE {WORD_SCORES}, {char_scores()},
scores AS (
  SELECT role, word_edits, word_total, char_edits, char_total
  FROM word_scores JOIN char_scores USING (conv_id, turn, role))"""

TIMED = f"""{UTTERANCES},
timed AS (
  SELECT doc_id, language, audio_size,
         CASE WHEN audio_size % 7 = 0 THEN NULL ELSE audio_size / 16000e0 END AS seconds FROM utterances),
judged AS (
  SELECT *, CASE WHEN seconds IS NULL THEN 'decode_failed' WHEN seconds > 40 THEN 'too_long' ELSE 'ok' END AS status
  FROM timed)"""

HOURS = """SELECT corpus, split, language,
  sum(audio_size)::DOUBLE / 16000e0 / 3600e0 AS hours, count(*) FILTER (audio_size IS NULL) AS null_sizes"""

SUBMISSION = r"""
submission AS (
  SELECT doc_id AS row_order, CASE WHEN n_chars % 20 = 0 THEN NULL ELSE n_chars::VARCHAR END AS sample_id,
         CASE WHEN lang = 'fr' THEN '' ELSE source END AS target FROM documents),
audio AS (
  SELECT n_chars::VARCHAR AS stem, min('/data/' || source || '/' || n_chars || '.wav') AS path
  FROM documents JOIN labels USING (doc_id) GROUP BY 1),
filled AS (
  SELECT s.*, CASE WHEN NOT contains(path, '/src7/') THEN 'heard in ' || path END AS prediction
  FROM submission s LEFT JOIN audio ON stem = sample_id)"""


def log_lines(name: str, kind: str | None = None) -> str:
    chosen = f"WHERE event_type = '{kind}'" if kind else ""
    return f"""
{name} AS (
  SELECT 'ws_' || user_id || '_' || event_id % 5 AS run, event_id AS line_order,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE floor(value)::BIGINT END AS step,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS loss,
         props ->> '$.k' AS wer, CASE WHEN event_id % 7 = 0 THEN NULL ELSE props ->> '$.k' END AS uer
  FROM events {chosen})"""


RUNS = f"""{log_lines("valid_all", "click")}, {log_lines("train_all", "view")},
valid AS (SELECT * FROM valid_all WHERE step IS NOT NULL AND loss IS NOT NULL),
train AS (SELECT * FROM train_all WHERE step IS NOT NULL AND loss IS NOT NULL),
saved AS (
  SELECT DISTINCT 'ws_' || user_id || '_' || event_id % 5 AS run, floor(value)::BIGINT AS step
  FROM events WHERE event_type = 'purchase'),
last_loss AS (SELECT run, step, arg_max(loss, line_order) AS train_loss FROM train GROUP BY ALL),
tiers AS (
  SELECT run, 1 AS tier, loss AS rank, line_order AS tie, step, loss AS eval_loss, NULL::DOUBLE AS train_loss, wer, uer
  FROM valid SEMI JOIN saved USING (run, step)
  UNION ALL
  SELECT run, 2, train_loss, step, step, NULL, train_loss, NULL, NULL
  FROM saved JOIN last_loss USING (run, step)
  UNION ALL
  SELECT run, 3, -step, step, step, NULL, NULL, NULL, NULL FROM saved),
best AS (
  SELECT run, step, eval_loss, train_loss, wer, uer, 'step_' || step AS path,
         CASE tier WHEN 1 THEN 'validation_ctc_loss' WHEN 2 THEN 'train_ctc_loss' ELSE 'latest_step' END AS selection_source
  FROM tiers
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY tier, rank, tie) = 1)"""

SHOWN = "coalesce(printf('%.{d}f', {x}), '')"


def shown(expression: str, decimals: int) -> str:
    return SHOWN.format(d=decimals, x=expression)


RATE = "CASE WHEN coalesce(sum({u}), 0) = 0 THEN 'nan'::DOUBLE ELSE sum({e})::DOUBLE / sum({u})::DOUBLE END"
WER_SUM = RATE.format(e="word_edits", u="word_total")
CER_SUM = RATE.format(e="char_edits", u="char_total")

PREDICTION_ROWS = """
SELECT (row_number() OVER (ORDER BY doc_id) - 1)::VARCHAR AS id, 'en' AS language, 'en_asr' AS config,
       'test' AS split, text AS reference, lower(text) AS prediction, 'card' AS model_card
FROM documents"""

REPORT_LINES = f"""{RUNS}, valid_lines AS (
  SELECT run, line_order, CASE WHEN line_order IS NULL THEN '| n/a | n/a | n/a | n/a |' ELSE
    '| ' || coalesce(step::VARCHAR, 'step?') || ' | ' || {shown("loss", 4)} || ' | ' || {shown("wer::DOUBLE", 2)}
    || ' | ' || {shown("uer::DOUBLE", 2)} || ' |' END AS line
  FROM (SELECT DISTINCT run FROM saved) LEFT JOIN valid_all USING (run)),
train_lines AS (
  SELECT run, line_order, '| ' || coalesce(step::VARCHAR, 'step?') || ' | ' || {shown("loss", 4)} || ' | '
    || {shown("uer::DOUBLE", 2)} || ' | ' || {shown("wer::DOUBLE", 2)} || ' | 0.00001000 |' AS line
  FROM train_all),
summary AS (
  SELECT run, unnest(['Best checkpoint: step_' || step, 'Checkpoint selection source: ' || selection_source,
    CASE WHEN eval_loss IS NOT NULL THEN 'Best validation CTC Loss: ' || printf('%.4f', eval_loss)
         WHEN train_loss IS NOT NULL THEN 'Best train CTC Loss: ' || printf('%.4f', train_loss) ELSE 'CTC Loss: n/a' END,
    CASE WHEN eval_loss IS NOT NULL THEN 'Best validation WER: ' || {shown("wer::DOUBLE", 2)}
         ELSE 'Validation metrics: n/a (validation disabled)' END,
    CASE WHEN eval_loss IS NOT NULL THEN 'Best validation UER: ' || {shown("uer::DOUBLE", 2)} END]) AS line,
    (generate_subscripts([1, 2, 3, 4, 5], 1) - 1)::INTEGER AS position FROM best)"""

HEADINGS = """headings AS (
  SELECT run, section, unnest(lines) AS line, (generate_subscripts(lines, 1) - 1)::INTEGER AS position
  FROM best, (VALUES (0, ['# Fine-tuned model', '', '## Training Summary', '']),
    (2, ['## Validation Metrics', '', '| Step | CTC Loss | WER | UER |', '|---|---|---|---|']),
    (4, ['', '## Training Metrics', '', '| Step | CTC Loss | UER | WER | Learning Rate |', '|---|---|---|---|---|']))
    AS t(section, lines))"""

def batches(chosen: str) -> str:
    """Rows in line by capacity, and what each capacity leaves open to the next."""
    return f"""{UTTERANCES},
fit AS (SELECT doc_id, audio_size FROM utterances WHERE {chosen}),
sharded AS (
  SELECT doc_id, audio_size, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % (SELECT greatest(1, (count(*) + 249) // 250) FROM fit) AS shard,
         960000 // greatest(audio_size, 1) AS capacity FROM fit),
runs AS (SELECT capacity, count(*) AS n, row_number() OVER (ORDER BY capacity) AS k FROM sharded WHERE capacity > 0 GROUP BY capacity),
scanned(k, capacity, carry, first, left_open, begun) AS (
  SELECT 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
  UNION ALL
  SELECT r.k, r.capacity, s.left_open, s.begun,
    CASE WHEN s.left_open >= r.n THEN s.left_open - r.n
         ELSE (r.n - s.left_open + r.capacity - 1) // r.capacity * r.capacity - (r.n - s.left_open) END,
    s.begun + CASE WHEN s.left_open >= r.n THEN 0 ELSE (r.n - s.left_open + r.capacity - 1) // r.capacity END
  FROM scanned s JOIN runs r ON r.k = s.k + 1),
lined AS (SELECT *, row_number() OVER (PARTITION BY capacity ORDER BY shard, audio_size, doc_id) - 1 AS place FROM sharded),
planned AS (
  SELECT doc_id, audio_size, capacity,
    CASE WHEN place < carry THEN first - 1 ELSE first + (place - carry) // nullif(capacity, 0) END AS batch
  FROM lined LEFT JOIN (FROM scanned WHERE k > 0) USING (capacity))"""


SQL = {
    "sanitize_keep": f"WITH {UTTERANCES} SELECT doc_id, {KEEP} AND num_samples >= 400 AS keep FROM utterances",
    "sanitized_rows": f"""WITH {UTTERANCES} SELECT doc_id, corpus, split, language, audio_size
FROM utterances WHERE {KEEP} AND num_samples >= 400""",
    "split_map_two": f"""WITH {CORPORA} SELECT doc_id, source, split, destination_split
FROM both_corpora JOIN split_pairs USING (source, split)""",
    "split_map_n": f"""WITH {CORPORA} SELECT doc_id, split,
CASE WHEN split IN ('validation', 'valid', 'dev') THEN 'validation' ELSE 'train' END AS destination_split FROM both_corpora""",
    "split_map_raw": f"""WITH {CORPORA} SELECT doc_id, split,
CASE WHEN split = 'validation' THEN 'validation' ELSE 'train' END AS destination_split FROM both_corpora""",
    "script_labels": """SELECT doc_id, CASE lang WHEN 'en' THEN 'sna_Latn' WHEN 'fr' THEN 'lug_Latn' WHEN 'de' THEN 'lin_Latn' ELSE lang END AS label,
CASE lang WHEN 'en' THEN 'sna' WHEN 'fr' THEN 'lug' WHEN 'de' THEN 'lin' ELSE lang END AS base FROM documents""",
    "lang_harmonize": f"WITH {CORPORA} SELECT doc_id, language FROM harmonized",
    "pair_lookup": "SELECT doc_id, source AS corpus, source || '-extra' AS companion FROM documents",
    "compose_union": f"""WITH {CORPORA} SELECT doc_id, source, corpus,
CASE WHEN source = 'second' THEN language END AS language, text, num_samples, quality FROM both_corpora""",
    "manifest": MANIFEST,
    "composition_gate": f"""WITH {COMPOSED} SELECT corpus, source_split, destination_split, source_language, language,
source_file AS file, before - after AS dropped_rows FROM per_file WHERE after = 0""",
    "manifest_round_trip": MANIFEST,
    "resolve_paths": f"""WITH {COMPOSED},
named AS (
  SELECT doc_id, {AUDIO_PATH} AS path, corpus NOT IN ('src3', 'src4', 'src5') AS open, doc_id || '.wav' AS file,
         '/data/' || corpus || '/' || split || '/' || language AS folder, corpus FROM utterances),
places AS (
  SELECT doc_id, unnest([folder, regexp_replace(folder, '/[^/]*$', ''), '/data/' || corpus, '/data']) || '/clips/' || file AS place,
         generate_subscripts([1, 2, 3, 4], 1) AS rank FROM named WHERE open),
found AS (SELECT doc_id, arg_min(place, rank) AS place FROM places WHERE place IN (SELECT path FROM inventory) GROUP BY 1)
SELECT doc_id, coalesce(place, path) AS path, place IS NOT NULL AS replaced FROM named LEFT JOIN found USING (doc_id)""",
    "compose_corpus": f"""WITH {COMPOSED} SELECT doc_id, source AS corpus, destination_split AS split, language,
split AS source_split, corpus AS origin, text, quality, source FROM sources JOIN split_pairs USING (source, split)
WHERE {KEEP} AND (source = 'second' OR num_samples >= 400)""",
    "compose_many": f"""WITH {COMPOSED} SELECT corpus, split AS source_split,
CASE WHEN split IN ('validation', 'dev') THEN 'validation' ELSE 'train' END AS destination_split,
source_language, source_language AS language, count(*) AS rows_before,
count(*) FILTER ({KEEP} AND (source = 'second' OR num_samples >= 400)) AS rows_after,
count(*) FILTER (NOT ({KEEP} AND (source = 'second' OR coalesce(num_samples >= 400, false)))) AS dropped_rows,
0::BIGINT AS normalized_audio_paths FROM sources GROUP BY ALL""",
    "column_guards": """SELECT 'documents' AS "table", NULL::VARCHAR AS missing, count(*) AS rows FROM documents
UNION ALL SELECT 'conversations', 'ID', count(*) FROM conversations
UNION ALL SELECT 'pages', 'transcription,audio', count(*) FROM pages""",
    "stream_skips": f"""WITH {UTTERANCES} SELECT CASE WHEN language = 'es' THEN 'decode_failed'
WHEN num_samples / 16000e0 > 40 THEN 'too_long' WHEN num_samples IS NULL THEN 'decode_failed' ELSE 'ok' END AS status,
count(*) AS samples FROM utterances GROUP BY 1""",
    "partitioned_scan": f"WITH {UTTERANCES} SELECT doc_id, corpus, split, language, audio_size FROM utterances",
    "partition_files": f"WITH {UTTERANCES} SELECT DISTINCT corpus, split, language FROM utterances",
    "raw_shard_scan": f"""WITH {UTTERANCES} SELECT doc_id, 'ASR' AS layout, language, split, '00000' AS shard, audio_size
FROM utterances WHERE split <> 'dev'""",
    "layout_inference": f"""WITH {UTTERANCES} SELECT CASE WHEN corpus = 'src1' THEN 'asr' ELSE 'ASR' END AS corpus, split, language,
CASE WHEN corpus = 'src1' THEN '/r/asr/' || language || '/part-' || doc_id || '-' || split || '.parquet'
     ELSE '/r/data/ASR/' || language || '/x/' || language || '-' || split || '-' || doc_id || '.parquet' END AS path
FROM utterances WHERE split <> 'dev' AND corpus NOT IN ('src2', 'src3')""",
    "glob_scan": f"WITH {UTTERANCES} SELECT doc_id, audio_size FROM utterances WHERE language IN ('fr', 'de')",
    "log_scan": f"""WITH {RUNS} SELECT 'ws_' || line_order % 20 AS run, step, loss, wer, uer FROM train WHERE line_order % 17 <> 0""",
    "submission_scan": f'WITH {SUBMISSION} SELECT sample_id, target AS "Target", count(*) AS rows FROM submission GROUP BY ALL',
    "audio_index": f"WITH {SUBMISSION} SELECT stem, path FROM audio",
    "evaluation_split": f"WITH {UTTERANCES} SELECT doc_id, 'fr_asr' AS config, split, text FROM utterances WHERE language = 'fr' AND split = 'test'",
    "hours": f"WITH {UTTERANCES} {HOURS} FROM utterances GROUP BY ALL",
    "sanitized_hours": f"""WITH {UTTERANCES}, kept AS (
  SELECT corpus, CASE WHEN split = 'dev' THEN 'validation' ELSE 'train' END AS split, language, audio_size
  FROM utterances WHERE {KEEP} AND num_samples >= 400) {HOURS} FROM kept GROUP BY ALL""",
    "distribution_table": f"""WITH {UTTERANCES} SELECT 'docs' AS dataset, split, language, corpus,
printf('%.6f', sum(audio_size)::DOUBLE / 16000e0 / 3600e0) AS hours, '/data' AS path FROM utterances GROUP BY ALL""",
    "train_groups": f"""WITH {UTTERANCES} SELECT count(DISTINCT corpus) AS corpora, count(DISTINCT language) AS languages,
CASE WHEN count(DISTINCT corpus) > 1 THEN 0.5e0 ELSE 0e0 END AS beta_corpus,
CASE WHEN count(DISTINCT language) > 1 THEN 0.5e0 ELSE 0e0 END AS beta_language FROM utterances WHERE split = 'train'""",
    "valid_split": f"""WITH {UTTERANCES} SELECT coalesce(arg_min(split, CASE split WHEN 'dev' THEN 0 WHEN 'validation' THEN 1 WHEN 'valid' THEN 2 END), 'dev') AS valid_split
FROM utterances WHERE split IN ('dev', 'validation', 'valid')""",
    "label_sets": f"WITH {UTTERANCES} SELECT DISTINCT corpus, split, language FROM utterances",
    "mixture_weights": f"""WITH {UTTERANCES},
h AS (SELECT corpus, language, sum(audio_size)::DOUBLE / 16000e0 / 3600e0 AS hours FROM utterances WHERE split = 'train' GROUP BY ALL),
c AS (SELECT corpus, sqrt(sum(hours)) AS p FROM h GROUP BY ALL),
w AS (SELECT corpus, p / sum(p) OVER () AS cw FROM c),
l AS (SELECT corpus, language, sqrt(hours) / sum(sqrt(hours)) OVER (PARTITION BY corpus) AS lw FROM h)
SELECT corpus, language, round(cw, 9) AS corpus_weight, round(lw, 9) AS language_weight, round(cw * lw, 9) AS weight FROM l JOIN w USING (corpus)""",
    "length_limits": f"""WITH {UTTERANCES} SELECT doc_id, audio_size,
CASE WHEN audio_size < 32000 THEN 'short' WHEN audio_size > 960000 THEN 'long' ELSE 'ok' END AS length_status FROM utterances""",
    "length_limits_llm": f"WITH {UTTERANCES} SELECT doc_id, audio_size FROM utterances WHERE audio_size BETWEEN 32000 AND 320000",
    "batch_plan": f"""WITH RECURSIVE {batches("audio_size BETWEEN 32000 AND 960000")} SELECT doc_id, capacity, batch FROM planned""",
    "batch_padding": f"""WITH RECURSIVE {batches("true")},
each_batch AS (SELECT batch, count(*) AS rows, sum(audio_size) AS samples, count(*) * max(audio_size) - sum(audio_size) AS padding
  FROM planned WHERE batch IS NOT NULL GROUP BY batch)
SELECT count(*) AS batches, sum(rows)::BIGINT AS rows, sum(samples)::BIGINT AS samples, sum(padding)::BIGINT AS padding FROM each_batch""",
    "duration_status": f"WITH {TIMED} SELECT doc_id, seconds, status FROM judged",
    "skip_counts": f"WITH {TIMED} SELECT language, status, count(*) AS samples FROM judged GROUP BY ALL",
    "capped_eval": f"""WITH {TIMED} SELECT doc_id, seconds FROM (SELECT * FROM judged ORDER BY audio_size, doc_id LIMIT 120) WHERE status = 'ok'""",
    "normalize_text": f"""WITH n AS (SELECT conv_id, turn, {NORMALIZED % "text"} AS normalized FROM conversations)
SELECT conv_id, turn, normalized, len(list_filter(string_split(normalized, ' '), lambda t: t <> '')) AS words,
length(replace(normalized, ' ', '')) AS chars FROM n""",
    "wer_pairs": f"WITH RECURSIVE {WORD_SCORES} SELECT conv_id, turn, word_edits, word_total FROM word_scores",
    "cer_pairs": f"WITH {PAIRS}, {char_scores()} SELECT conv_id, turn, char_edits, char_total FROM char_scores",
    "wer": f"""WITH RECURSIVE {WORD_SCORES} SELECT count(*) AS num_samples, sum(word_edits)::BIGINT AS word_edits,
sum(word_total)::BIGINT AS word_total, {WER_SUM} AS wer FROM word_scores""",
    "cer": f"""WITH {PAIRS}, {char_scores()} SELECT role, count(*) AS num_samples, sum(char_edits)::BIGINT AS char_edits,
sum(char_total)::BIGINT AS char_total, {CER_SUM} AS cer FROM char_scores GROUP BY role""",
    "run_summary": f"""{ALL_SCORES} SELECT 'turns' AS dataset, role || '_asr' AS config, 'test' AS split, count(*) AS num_samples,
'm' AS model_card, NULL::VARCHAR AS omni_lang, {WER_SUM} AS wer, {CER_SUM} AS cer FROM scores GROUP BY role""",
    "pair_by_id": """SELECT count(*) AS num_samples, count(*) FILTER (role = 'assistant') AS heard,
sum(length(text) - length(replace(text, 'e', ''))) FILTER (role = 'assistant')::BIGINT AS char_edits FROM conversations""",
    "slug": "SELECT page_id, regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g') AS slug FROM pages",
    "prediction_rows": PREDICTION_ROWS,
    "predictions_json": PREDICTION_ROWS,
    "infer_batches": """SELECT doc_id, CASE WHEN NOT contains(text, '|') THEN replace(text, 'e', '') END AS prediction,
CASE WHEN contains(text, '|') THEN 'unreadable' END AS error FROM documents""",
    "evaluation_run": """SELECT doc_id::VARCHAR AS id, lang AS language, 'en_asr' AS config, 'test' AS split, text AS reference,
replace(text, 'e', '') AS prediction, 'a card' AS model_card FROM documents
WHERE lang <> 'es' AND (strlen(text) // (doc_id % 2 + 1)) / (CASE WHEN lang = 'fr' THEN 8000e0 ELSE 16000e0 END) <= 0.1 AND NOT contains(text, 'ou')""",
    "evaluation_errors": """SELECT doc_id::VARCHAR AS id, 'unheard' AS error FROM documents WHERE lang <> 'es' AND contains(text, 'ou')
AND (strlen(text) // (doc_id % 2 + 1)) / (CASE WHEN lang = 'fr' THEN 8000e0 ELSE 16000e0 END) <= 0.1""",
    "evaluation_metrics": f"""WITH texts AS (
  SELECT lang, text, doc_id, replace({NORMALIZED % "text"}, ' ', '') AS ref,
    replace({NORMALIZED % "replace(text, 'e', '')"}, ' ', '') AS hyp FROM documents)
SELECT 'docs' AS dataset, 'en_asr' AS config, 'test' AS split, count(*) AS num_samples, 'a card' AS model_card,
NULL::VARCHAR AS omni_lang, sum(length(ref) - length(hyp)) / sum(length(ref)) AS cer
FROM texts WHERE lang <> 'es' AND NOT contains(text, 'ou')
AND (strlen(text) // (doc_id % 2 + 1)) / (CASE WHEN lang = 'fr' THEN 8000e0 ELSE 16000e0 END) <= 0.1""",
    "evaluation_skips": """SELECT CASE WHEN lang = 'es' THEN 'decode_failed'
  WHEN (strlen(text) // (doc_id % 2 + 1)) / (CASE WHEN lang = 'fr' THEN 8000e0 ELSE 16000e0 END) > 0.1 THEN 'too_long'
  WHEN contains(text, 'ou') THEN 'recognition_failed' ELSE 'ok' END AS status,
count(*) AS samples FROM documents GROUP BY 1""",
    "wav_metadata": """SELECT doc_id, CASE WHEN lang <> 'es' THEN CASE WHEN lang = 'fr' THEN 8000 ELSE 16000 END END::BIGINT AS sample_rate,
CASE WHEN lang <> 'es' THEN doc_id % 2 + 1 END AS channels,
CASE WHEN lang <> 'es' THEN strlen(text) // (doc_id % 2 + 1) END AS n_samples FROM documents""",
    "mono_mix": """SELECT vec_id, (i - 1)::INTEGER AS sample,
((embedding[i]::DOUBLE + embedding[len(embedding) + 1 - i]::DOUBLE) / 2)::FLOAT AS value
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
    "unique_ids": f"WITH {SUBMISSION} SELECT sample_id, min(row_order) AS first_row FROM submission WHERE sample_id IS NOT NULL GROUP BY 1",
    "missing_ids": f"""WITH {SUBMISSION} SELECT DISTINCT sample_id FROM submission
WHERE sample_id IS NOT NULL AND sample_id NOT IN (SELECT stem FROM audio)""",
    "fill_target": f"""WITH {SUBMISSION} SELECT row_order, coalesce(prediction, target) AS "Target", prediction IS NOT NULL AS filled FROM filled""",
    "fill_report": f"""WITH {SUBMISSION}, ids AS (
  SELECT DISTINCT sample_id, path FROM submission LEFT JOIN audio ON stem = sample_id WHERE sample_id IS NOT NULL)
SELECT (SELECT count(*) FROM filled WHERE prediction IS NOT NULL) AS filled_rows, (SELECT count(*) FROM filled) AS total_rows,
count(*) AS unique_ids, count(*) FILTER (path IS NULL) AS missing_ids, count(*) FILTER (contains(path, '/src7/')) AS decode_skips FROM ids""",
    "filled_csv": f"""WITH {SUBMISSION} SELECT row_order AS row, coalesce(prediction, target) AS "Target" FROM filled""",
    "best_checkpoint": f"WITH {RUNS} SELECT * FROM best",
    "train_last": f"WITH {RUNS} SELECT * FROM last_loss",
    "valid_with_checkpoint": f"WITH {RUNS} SELECT run, line_order, step, loss FROM valid SEMI JOIN saved USING (run, step)",
    "checkpoint_losses": f"WITH {RUNS} SELECT run, step, train_loss FROM saved LEFT JOIN last_loss USING (run, step)",
    "checkpoint_steps": f"WITH {RUNS} SELECT run, step FROM saved",
    "run_folders": f"WITH {log_lines('train_all', 'view')} SELECT count(DISTINCT run) AS runs, count(DISTINCT run) <> 1 AS refused FROM train_all",
    "lenient_numbers": f"""WITH {log_lines("every")} SELECT line_order, step, trunc(loss)::BIGINT AS whole, loss, {shown("loss", 4)} AS shown FROM every""",
    "metrics_report": f"WITH {REPORT_LINES} SELECT * FROM valid_lines",
    "train_report": f"WITH {REPORT_LINES} SELECT * FROM train_lines",
    "report_summary": f"WITH {REPORT_LINES} SELECT run, position, line FROM summary WHERE line IS NOT NULL",
    "full_report": f"""WITH {REPORT_LINES}, {HEADINGS}
SELECT run, section, position, NULL::BIGINT AS line_order, line FROM headings
UNION ALL SELECT run, 1, position * 2, NULL, line FROM summary WHERE line IS NOT NULL
UNION ALL SELECT run, 1, position * 2 + 1, NULL, '' FROM summary WHERE line IS NOT NULL
UNION ALL SELECT run, 3, 0, line_order, line FROM valid_lines
UNION ALL SELECT run, 5, 0, line_order, line FROM train_lines SEMI JOIN saved USING (run)""",
    "stream_predictions": f"""WITH {UTTERANCES} SELECT doc_id, CASE WHEN NOT contains(text, '|') THEN replace(text, 'e', '') END AS prediction
FROM utterances WHERE num_samples / 16000e0 <= 40""",
    "stream_totals": f"""{ALL_SCORES}, skips AS (
  SELECT role, count(*) AS skipped FROM word_scores WHERE conv_id % 5 = 0 GROUP BY role),
scored AS (SELECT w.role, w.word_edits, w.word_total, c.char_edits, c.char_total
  FROM word_scores w JOIN char_scores c USING (conv_id, turn, role) WHERE conv_id % 5 <> 0),
totals AS (SELECT role, count(*) AS num_samples, sum(word_edits)::BIGINT AS word_edits, sum(word_total)::BIGINT AS word_total,
sum(char_edits)::BIGINT AS char_edits, sum(char_total)::BIGINT AS char_total, {WER_SUM} AS wer, {CER_SUM} AS cer FROM scored GROUP BY role)
SELECT totals.*, coalesce(skipped, 0) AS skipped FROM totals LEFT JOIN skips USING (role)""",
    "hours_files": f"WITH {UTTERANCES} {HOURS} FROM utterances GROUP BY ALL",
    "resolve_paths_files": f"""WITH {UTTERANCES} SELECT doc_id, CASE doc_id % 5
  WHEN 0 THEN '/corpus=' || corpus || '/split=' || split || '/language=' || language || '/clips/'
  WHEN 1 THEN '/corpus=' || corpus || '/split=' || split || '/clips/' WHEN 2 THEN '/corpus=' || corpus || '/clips/'
  WHEN 3 THEN '/clips/' ELSE 'clips/' END || doc_id || '.wav' AS path, 'mine' AS source
FROM utterances WHERE {KEEP} AND num_samples >= 400""",
    "schema_groups": f"""WITH {UTTERANCES} SELECT doc_id,
(doc_id % 3 = 1 OR coalesce(regexp_matches(text, '[^{WS}]'), false))
AND (doc_id % 3 = 2 OR coalesce(NOT isnan(duration) AND duration >= 0.03, false)) AND num_samples >= 400 AS keep FROM utterances""",
    "audio_files": "SELECT 'd' || doc_id AS stem, octet_length(encode(text)) AS bytes FROM documents WHERE text <> ''",
    "array_audio": """SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 0 ELSE 16000 END::BIGINT AS sample_rate,
CASE WHEN vec_id % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS channels, len(embedding)::BIGINT AS n_samples,
CASE WHEN vec_id % 7 = 0 THEN 'decode_failed' WHEN len(embedding) / 16000e0 > 0.003 THEN 'too_long' ELSE 'ok' END AS status
FROM embeddings""",
    "audio_containers": """WITH made AS (
  SELECT doc_id, lang, CASE doc_id % 8 WHEN 0 THEN 22050 WHEN 1 THEN 8000 WHEN 2 THEN 16000 WHEN 3 THEN 44100
      WHEN 4 THEN 48000 WHEN 5 THEN 44100 WHEN 6 THEN 48000 ELSE 16000 END::BIGINT AS rate,
    CASE WHEN doc_id % 8 IN (2, 3, 4) THEN 2 ELSE 1 END::BIGINT AS channels,
    CASE doc_id % 8 WHEN 0 THEN strlen(text) // 4 WHEN 1 THEN least(n_chars + 1, (strlen(text) + 255) // 256 * 505)
      WHEN 2 THEN strlen(text) // 2 WHEN 3 THEN n_chars WHEN 4 THEN n_chars * 100 WHEN 5 THEN n_chars * 1152
      WHEN 6 THEN (n_chars % 50 + 2) * 1152 ELSE n_chars END::BIGINT AS samples FROM documents)
SELECT doc_id, CASE WHEN lang <> 'es' THEN rate END AS sample_rate, CASE WHEN lang <> 'es' THEN channels END AS channels,
  CASE WHEN lang <> 'es' THEN samples END AS n_samples,
  CASE WHEN lang = 'es' THEN 'decode_failed' WHEN samples > rate THEN 'too_long' ELSE 'ok' END AS status FROM made""",
}
