"""DuckDB SQL for every catalog key: the same results computed a second way.

The driver registers the parquet tables as views; each string below reads
them and must return the same columns as ``catalog.QUERIES[key]``. Order
statistics that Spark finds without a global sort (ordinals, the split) are
written here with plain window functions over the whole table.
"""

from __future__ import annotations

# Fixed values, stated here again so that a wrong constant in the code shows.
SYSTEM_PROMPT = ("You are a careful reading-comprehension assistant. "
                 "Use ONLY the provided passage to answer the question.")
SCRATCHPAD_TEXT = "Read the passage, locate the span that answers the question, and state it succinctly."
NO_CONTEXT_PLACEHOLDER = "(No additional passage provided. Answer only if you are certain.)"
SPECIAL_TOKENS = ["<|im_start|>", "<|im_end|>", "<scratchpad>", "</scratchpad>", "<final>", "</final>", "user", "assistant"]
SPECIALS_RE = r"(<\|im_start\|>|<\|im_end\|>|<scratchpad>|</scratchpad>|<final>|</final>|user|assistant)"
TOKENS_RE = r"\x01[^\x01]+\x01|[\p{L}\p{N}]+|[^ \t\n\x0B\f\r\x01]"
SEP, BUCKETS = chr(1), 131072
MARKER, USER_TURN, END_THEN_MARKER, END_ID, PAD_ID = [0, 7], [0, 6], [1, 0, 7], [1], 1
PY_WHITESPACE = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
from chatmill.plans import catalog as C


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = "(" + " || ".join(f"chr({c})" for c in PY_WHITESPACE) + ")"


def trim(x): return f"trim({x}, {WS})"
def rtrim(x): return f"rtrim({x}, {WS})"
def clean(x): return trim(f"coalesce({x}, '')")
def first_nonempty(*xs): return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in xs) + ", '')"
def str_at(j, path): return f"(CASE WHEN json_type({j}, {lit(path)}) = 'VARCHAR' THEN json_extract_string({j}, {lit(path)}) END)"
def digest(x): return f"md5(array_to_string({x}, ','))"


def instruction(q, ctx):
    head = f"<|im_start|>system\n{SYSTEM_PROMPT}\n<|im_end|>\n<|im_start|>user\nQuestion: "
    return f"{lit(head)} || {clean(q)} || {lit(chr(10) * 2 + 'Context:' + chr(10))} || {clean(ctx)} || " \
           f"{lit(chr(10) + '<|im_end|>' + chr(10) + '<|im_start|>assistant')}"


def output(a):
    return f"{lit('<scratchpad>' + SCRATCHPAD_TEXT + '</scratchpad>' + chr(10) + '<final>')} || {clean(a)} || " \
           f"{lit('</final>' + chr(10) + '<|im_end|>')}"


def text_of(i="instruction", o="output"):
    return f"{rtrim(f'coalesce({i}, {chr(39)}{chr(39)})')} || chr(10) || chr(10) || {rtrim(f'coalesce({o}, {chr(39)}{chr(39)})')} || chr(10)"


def tokens_of(text):
    wrapped = f"regexp_replace(replace({text}, chr(1), ''), {lit(SPECIALS_RE)}, {lit(SEP + chr(92) + '1' + SEP)}, 'g')"
    return f"list_transform(regexp_extract_all({wrapped}, {lit(TOKENS_RE)}, 0), lambda t: replace(t, chr(1), ''))"


def ids_of(tokens):
    cases = " ".join(f"WHEN {lit(s)} THEN {i}" for i, s in enumerate(SPECIAL_TOKENS))
    hashed = f"{len(SPECIAL_TOKENS)} + (('0x' || substr(md5(t), 1, 15))::BIGINT % {BUCKETS})"
    return f"list_transform({tokens}, lambda t: CASE t {cases} ELSE {hashed} END)::INTEGER[]"


def find(ids, needle):
    m = len(needle)
    if m == 0:
        return "-1"
    if m == 1:
        return f"coalesce(list_position({ids}, {needle[0]}) - 1, -1)"
    cond = " AND ".join(f"{ids}[i + {j + 1}] = {v}" for j, v in enumerate(needle))
    return f"coalesce(list_filter(range(0, greatest(len({ids}) - {m - 1}, 0)), lambda i: {cond})[1], -1)"


def occurrences(ids, needle):
    """Every place where the needle begins."""
    cond = " AND ".join(f"{ids}[i + {j + 1}] = {v}" for j, v in enumerate(needle))
    return f"len(list_filter(range(0, greatest(len({ids}) - {len(needle) - 1}, 0)), lambda i: {cond}))::BIGINT"


def ones(x): return f"list_transform({x}, lambda z: 1)"
def repeat(v, n): return f"list_transform(range(0, {n}), lambda z: {v})"


# --- adapter and records ---------------------------------------------------------
PAIRS = """
users AS (
  SELECT conv_id, turn, text AS question, row_number() OVER (ORDER BY conv_id, turn) - 1 AS ordinal
  FROM conversations WHERE role = 'user'),
answers AS (
  SELECT conv_id, turn - 1 AS turn, text AS answer_text FROM conversations WHERE role = 'assistant'),
pairs AS (
  SELECT u.conv_id, u.turn, u.question, u.ordinal, a.answer_text, d.text AS doc_text
  FROM users u
  LEFT JOIN answers a ON a.conv_id = u.conv_id AND a.turn = u.turn
  LEFT JOIN documents d ON d.doc_id = u.conv_id)"""

EP = ("CASE shape WHEN 0 THEN json_array(json_object('wiki_context', doc_text))::VARCHAR "
      "WHEN 1 THEN json_array(json_object('wiki_context', '  ', 'text', doc_text))::VARCHAR "
      "WHEN 2 THEN '[]' WHEN 4 THEN '[{}]' "
      "WHEN 5 THEN json_array(json_object(), json_object('text', doc_text))::VARCHAR END")
EV = ("CASE shape WHEN 1 THEN json_array(page_html)::VARCHAR "
      "WHEN 2 THEN json_array(json_object('text', '', 'value', doc_text))::VARCHAR "
      "WHEN 4 THEN '[]' WHEN 5 THEN json_array(json_array(doc_text))::VARCHAR END")
SR = ("CASE shape WHEN 2 THEN '[]' "
      "WHEN 3 THEN json_array(json_object('snippet', page_url, 'title', doc_text))::VARCHAR "
      "WHEN 4 THEN json_object('zz', json_array(json_object('snippet', doc_text)), 'aa', json_object('title', page_url))::VARCHAR "
      "WHEN 5 THEN json_object('d', json_array(page_url))::VARCHAR END")


def key_of(source): return f"'{source}:' || conv_id || ':' || turn"


def sources(caps=None):
    w = (lambda s: f"WHERE ordinal < {caps[s]}") if caps else (lambda s: "")
    answers = "CASE WHEN answer_text IS NOT NULL THEN [answer_text] ELSE []::VARCHAR[] END"
    return PAIRS + f""",
squad_src AS (
  SELECT 'squad' AS source, {key_of('squad')} AS rec_key, question, doc_text AS context, {answers} AS answers_text
  FROM pairs {w('squad')}),
squad_v2_src AS (
  SELECT 'squad_v2' AS source, {key_of('squad_v2')} AS rec_key, question, doc_text AS context,
         {answers} AS answers_text, answer_text IS NULL AS is_impossible
  FROM pairs {w('squad_v2')}),
trivia_src AS (
  SELECT 'trivia_qa' AS source, {key_of('trivia_qa')} AS rec_key, question, answer_text AS answer_value,
         {EP} AS entity_pages, {EV} AS evidence, {SR} AS search_results
  FROM (SELECT p.*, g.html AS page_html, g.url AS page_url, ((p.conv_id % 6) + 6) % 6 AS shape
        FROM pairs p LEFT JOIN pages g ON g.page_id = p.conv_id) {w('trivia_qa')})"""


def context_sql(ep="entity_pages", ev="evidence", sr="search_results"):
    t1 = trim(first_nonempty(*[str_at(ep, f"$[0].{k}") for k in ("wiki_context", "text", "content")]))
    t2 = trim(f"coalesce({str_at(ev, '$[0]')}, {first_nonempty(*[str_at(ev, f'$[0].{k}') for k in ('text', 'value')])})")
    t3 = trim(first_nonempty(*[str_at(sr, f"$[0].{k}") for k in ("description", "snippet", "title")]))
    v = f"json_extract({sr}, '$.\"' || k || '\"')"
    walk = trim(first_nonempty(*[str_at(v, f"{p}.{k}") for p in ("$", "$[0]") for k in ("description", "snippet", "title")]))
    t4 = f"CASE WHEN json_type({sr}) = 'OBJECT' THEN list_filter(list_transform(json_keys({sr}), lambda k: {walk}), lambda x: x <> '')[1] END"
    return f"coalesce(nullif({t1}, ''), nullif({t2}, ''), nullif({t3}, ''), {t4}, {lit(NO_CONTEXT_PLACEHOLDER)})"


def obj(**fields): return "json_object(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"
def arr(*items): return "json_array(" + ", ".join(items) + ")"
def by_shape(**cases): return "CASE shape " + " ".join(f"WHEN {k[1:]} THEN ({v})::VARCHAR" for k, v in cases.items()) + " END"


# the typed sources as JSON text: a null field is a missing key
TYPED = {
    "lists": (by_shape(s0=arr(obj(wiki_context="doc_text")), s1=arr(obj(wiki_context="'  '", text="doc_text")), s2="'[]'", s4="'[{}]'", s5=arr("json_object()", obj(text="doc_text"))),
              by_shape(s1=arr("page_html"), s2=arr("''"), s4="'[]'"),
              by_shape(s2=arr(obj(title="page_url")), s3=arr(obj(snippet="page_url", title="doc_text")), s4="'[]'")),
    "maps": (by_shape(s0=arr(obj(content="doc_text")), s1=arr(obj(wiki_context="''", text="'  '")), s2="'[]'"),
             by_shape(s1=arr(obj(value="page_html")), s2=arr(obj(text="''", value="doc_text"))),
             by_shape(s3=obj(zz=arr(obj(snippet="'  '", title="page_url")), aa=arr(obj(title="doc_text"))), s4=obj(zz="json_array()", aa=arr(obj(snippet="page_url"))), s5="'{}'")),
    "structs": (by_shape(s0=obj(wiki_context=arr("doc_text")), s3=obj(wiki_context=arr("doc_text"))),
                by_shape(s1=arr(arr("doc_text"))),
                by_shape(s0=obj(zz=obj(description="doc_text"), aa=arr(obj(snippet="page_url"))), s1=obj(aa=arr(obj(snippet="page_url"))),
                         s2=obj(zz=obj(description="''", title="' '"), aa=arr(obj(snippet="doc_text"))))),
}


F1 = f"{clean('question')} <> '' AND {clean('context')} <> '' AND len(answers_text) > 0 AND answers_text[1] IS NOT NULL"
F2 = "NOT coalesce(is_impossible, false)"
F3 = f"{clean('question')} <> '' AND {clean('answer_value')} <> ''"


def records(caps=None, include=("squad", "squad_v2", "trivia_qa")):
    parts = {
        "squad": f"SELECT source, rec_key, {instruction('question', 'context')} AS instruction, "
                 f"{output('answers_text[1]')} AS output FROM squad_src WHERE {F1}",
        "squad_v2": f"SELECT source, rec_key, {instruction('question', 'context')} AS instruction, "
                    f"{output('answers_text[1]')} AS output FROM squad_v2_src WHERE {F2} AND {F1}",
        "trivia_qa": f"SELECT source, rec_key, {instruction('question', 'context')} AS instruction, "
                     f"{output('answer_value')} AS output FROM (SELECT *, {context_sql()} AS context "
                     f"FROM trivia_src WHERE {F3})",
    }
    body = "\nUNION ALL\n".join(parts[s] for s in include)
    return sources(caps) + f",\nrecords AS (\n{body})"


def labeled(caps=None):
    return records(caps) + f""",
keyed AS (SELECT *, ('0x' || substr(md5('{C.SEED}:' || rec_key), 1, 15))::BIGINT AS shuffle_key FROM records),
counted AS (SELECT *, row_number() OVER (ORDER BY shuffle_key, rec_key) AS rn, count(*) OVER () AS n FROM keyed),
labeled AS (
  SELECT *, CASE WHEN rn <= CAST(floor(CAST(n AS DOUBLE) * {C.VAL_FRACTION}) AS BIGINT) THEN 'val' ELSE 'train' END AS split
  FROM counted)"""


def tok_rows(src="records", keep="rec_key"):
    return f"SELECT {keep}, {ids_of(tokens_of(text_of()))} AS ids FROM {src}"


def window_path(src_sql, keep, L, marker=MARKER, k=8):
    m = len(marker)
    lead = max(m + 1, L // 4)
    ok = lambda s: f"(pos >= 0 AND pos - {s} + {m} <= w AND w - (pos - {s}) - {m} >= {k})"
    return f"""
SELECT {keep}, win AS input_ids, {ones('win')} AS attention_mask,
       list_concat({repeat(-100, 'upto')}, win[upto + 1 : len(win)]) AS labels
FROM (
  SELECT {keep}, ids[st + 1 : st + w] AS win, pos - st + {m} AS upto, w
  FROM (
    SELECT {keep}, ids, pos, w,
           CASE WHEN {ok('st1')} THEN st1 WHEN n > {L} AND {ok('st2')} THEN st2 END AS st
    FROM (
      SELECT {keep}, ids, pos, len(ids) AS n, least(len(ids), {L}) AS w,
             CASE WHEN len(ids) <= {L} THEN 0 ELSE greatest(0, least(pos - {lead}, len(ids) - {L})) END AS st1,
             greatest(0, least(pos - 1, len(ids) - {L})) AS st2
      FROM (SELECT {keep}, ids, {find('ids', marker)} AS pos FROM ({src_sql}) s0) s1) s2) s3
  WHERE st IS NOT NULL) s4
WHERE w - upto >= 8"""


def raw_path(src_sql, keep, L, marker=MARKER):
    m = len(marker)
    return f"""
SELECT {keep}, ids AS input_ids, {ones('ids')} AS attention_mask, labels
FROM (
  SELECT {keep}, ids,
         CASE WHEN pos < 0 THEN ids ELSE list_concat({repeat(-100, f'pos + {m}')}, ids[pos + {m + 1} : len(ids)]) END AS labels,
         CASE WHEN pos < 0 THEN len(ids) ELSE len(ids) - pos - {m} END AS sup
  FROM (SELECT {keep}, ids, {find('ids', marker)} AS pos
        FROM (SELECT {keep}, full_ids[1 : {L}] AS ids FROM ({src_sql}) r0) r1) r2) r3
WHERE sup >= 8"""


def tok_digests(keep=""):
    pre = f"{keep}, " if keep else ""
    return (f"{pre}len(input_ids)::BIGINT AS n_ids, {digest('input_ids')} AS ids_md5, "
            f"{digest('labels')} AS labels_md5, {digest('attention_mask')} AS mask_md5")


def with_q(ctes, body): return f"WITH {ctes}\n{body}"


def split_src(split):
    return (f"SELECT rec_key, shuffle_key, {ids_of(tokens_of(text_of()))} AS ids FROM labeled "
            f"WHERE split = '{split}'")


def ordered_window(split, L):
    w = window_path(split_src(split), "rec_key, shuffle_key", L)
    return f"SELECT row_number() OVER (ORDER BY shuffle_key, rec_key) - 1 AS ordinal, * FROM ({w}) o"


def ordered_raw(split, L):
    src = (f"SELECT rec_key, shuffle_key, {ids_of(tokens_of(text_of()))} AS full_ids FROM labeled "
           f"WHERE split = '{split}'")
    w = raw_path(src, "rec_key, shuffle_key", L)
    return f"SELECT row_number() OVER (ORDER BY shuffle_key, rec_key) - 1 AS ordinal, * FROM ({w}) o"


def raw_of_records(L):
    src = f"SELECT rec_key, {ids_of(tokens_of(text_of()))} AS full_ids FROM records"
    return raw_path(src, "rec_key", L)


def window_of_records(L):
    return window_path(tok_rows(), "rec_key", L)


def vocab_sql(n):
    ns = len(SPECIAL_TOKENS)
    sp = " ".join(f"WHEN {lit(s)} THEN {i}" for i, s in enumerate(SPECIAL_TOKENS))
    in_sp = ", ".join(lit(s) for s in SPECIAL_TOKENS)
    return f""",
toks AS (SELECT rec_key, {tokens_of(text_of())} AS toks FROM records),
counts AS (SELECT t AS token, count(*) AS count FROM (SELECT unnest(toks) AS t FROM toks) GROUP BY t),
vocab AS (
  SELECT token, (CASE token {sp} END)::INTEGER AS id, count FROM counts WHERE token IN ({in_sp})
  UNION ALL
  SELECT token, id, count FROM (
    SELECT token, count, (row_number() OVER (ORDER BY count DESC, token ASC) + {ns - 1})::INTEGER AS id
    FROM counts WHERE token NOT IN ({in_sp})) WHERE id < {n}
)"""


def build() -> dict[str, str]:
    R = records()
    L = labeled()
    q: dict[str, str] = {}
    q["scan_span_qa"] = with_q(sources(), "SELECT rec_key, question, context, len(answers_text)::BIGINT AS n_answers, answers_text[1] AS answer FROM squad_src")
    q["scan_span_qa_v2"] = with_q(sources(), "SELECT rec_key, question, context, len(answers_text)::BIGINT AS n_answers, answers_text[1] AS answer, is_impossible FROM squad_v2_src")
    q["scan_evidence_qa"] = with_q(sources(), "SELECT rec_key, question, answer_value, entity_pages IS NOT NULL AS has_entity_pages, evidence IS NOT NULL AS has_evidence, search_results IS NOT NULL AS has_search_results FROM trivia_src")
    q["scan_jsonl"] = with_q(L, "SELECT row_number() OVER (ORDER BY shuffle_key, rec_key) - 1 AS ordinal, instruction, output FROM labeled WHERE split = 'train'")
    q["scan_tokenized"] = with_q(L, f"SELECT ordinal, {tok_digests()} FROM ({ordered_window('train', C.WINDOW_L)}) x")
    q["resolve_split"] = with_q(L, f"""SELECT 'train' AS split, 'tokenized' AS origin, ordinal, {tok_digests()} FROM ({ordered_window('train', C.WINDOW_L)}) a
UNION ALL SELECT 'val' AS split, 'raw' AS origin, ordinal, {tok_digests()} FROM ({ordered_raw('val', C.RAW_L)}) b""")
    q["include_sources"] = with_q(records(include=("squad", "trivia_qa")), "SELECT source, rec_key, md5(instruction) AS instruction_md5, md5(output) AS output_md5 FROM records")
    q["clean_text"] = f"SELECT conv_id, turn, {clean('text')} AS cleaned, {clean(f'{WS} || text || {WS}')} = {clean('text')} AS padded_same FROM conversations"
    q["first_answer"] = with_q(sources(), "SELECT rec_key, len(answers_text)::BIGINT AS n_answers, answers_text[1] AS answer FROM squad_src")
    q["render_instruction"] = with_q(sources(), f"SELECT rec_key, {instruction('question', 'context')} AS instruction FROM squad_src")
    q["render_output"] = with_q(sources(), f"SELECT rec_key, {output('answers_text[1]')} AS output FROM squad_src WHERE answers_text[1] IS NOT NULL")
    q["make_records"] = with_q(R, "SELECT source, rec_key, instruction, output FROM records WHERE source = 'squad'")
    q["resolve_context"] = with_q(sources(), f"SELECT rec_key, {context_sql()} AS context FROM trivia_src")
    q["resolve_context_typed"] = with_q(PAIRS, "SELECT form, question_md5, context_md5, count(*) AS n FROM (" + " UNION ALL ".join(
        f"SELECT {lit(form)} AS form, md5(question) AS question_md5, md5({context_sql()}) AS context_md5 FROM (SELECT question, {ep} AS entity_pages, {ev} AS evidence, {sr} AS search_results "
        "FROM (SELECT p.*, g.html AS page_html, g.url AS page_url, ((p.conv_id % 6) + 6) % 6 AS shape FROM pairs p LEFT JOIN pages g ON g.page_id = p.conv_id) s) t"
        for form, (ep, ev, sr) in TYPED.items()) + ") u GROUP BY ALL")
    tallied = " UNION ALL ".join(f"SELECT '{c}' AS field, {c} AS j FROM trivia_src" for c in ("entity_pages", "evidence", "search_results"))
    q["context_fields"] = with_q(sources(), f"""SELECT field, count(*) AS n_rows, count(*) FILTER (WHERE j IS NULL) AS n_missing,
  count(*) FILTER (WHERE json_valid(j)) AS n_json, 0::BIGINT AS n_repeated_keys, count(*) FILTER (WHERE j IS NOT NULL AND NOT json_valid(j)) AS n_unparsable
FROM ({tallied}) x GROUP BY field""")
    q["build_text"] = with_q(R, f"SELECT rec_key, {text_of()} AS text FROM records")
    q["preview"] = with_q(L, "SELECT split, substr(instruction, 1, 500) AS instruction, substr(output, 1, 300) AS output FROM (SELECT split, instruction, output, row_number() OVER (PARTITION BY split ORDER BY shuffle_key, rec_key) AS r FROM labeled) WHERE r = 1")
    q["filter_span_qa"] = with_q(sources(), f"SELECT rec_key FROM squad_src WHERE {F1}")
    q["filter_answerable"] = with_q(sources(), f"SELECT rec_key, is_impossible FROM squad_v2_src WHERE {F2}")
    q["filter_evidence_qa"] = with_q(sources(), f"SELECT rec_key FROM trivia_src WHERE {F3}")
    q["window_boundary"] = with_q(R, f"SELECT {tok_digests('rec_key')} FROM ({window_path(tok_rows(), 'rec_key', C.CROP_L, k=C.ANSWER_K)}) x")
    q["filter_min_supervised"] = with_q(R, " UNION ALL ".join(f"SELECT {n}::BIGINT AS max_length, rec_key FROM ({raw_of_records(n)}) x{n}" for n in C.SUPERVISED_LS))
    reply = "coalesce(answer_text, '')"
    q["filter_nonempty"] = with_q(R, f"""SELECT rec_key, len(ids)::BIGINT AS n_ids, {digest('ids')} AS ids_md5 FROM (
  SELECT rec_key, input_ids AS ids FROM ({window_of_records(C.WINDOW_L)}) w
  UNION ALL SELECT {key_of('reply')} AS rec_key, {ids_of(tokens_of(reply))} AS ids FROM pairs) x WHERE len(ids) > 0""")
    q["marker_tally"] = with_q(R, f"""SELECT needle, source, n_markers, count(*) AS n_rows FROM (""" + " UNION ALL ".join(
        f"SELECT '{name}' AS needle, source, {occurrences('ids', needle)} AS n_markers FROM ({tok_rows(keep='source')}) x" for name, needle in C.TALLIED.items())
        + ") y GROUP BY ALL")
    q["split_counts"] = with_q(L, "SELECT count(*) AS num_total, count(*) FILTER (WHERE split = 'train') AS num_train, count(*) FILTER (WHERE split = 'val') AS num_val FROM labeled")
    q["dataset_sizes"] = with_q(L, f"""SELECT 'train' AS split, count(*) AS n FROM ({ordered_window('train', C.WINDOW_L)}) a
UNION ALL SELECT 'eval' AS split, count(*) AS n FROM ({ordered_raw('val', C.RAW_L)}) b""")
    q["supervised_tokens"] = with_q(R, f"SELECT rec_key, len(list_filter(labels, lambda x: x <> -100))::BIGINT AS n_supervised FROM ({window_of_records(C.WINDOW_L)}) x")
    q["prefix_cap"] = with_q(PAIRS, f"SELECT conv_id, turn, question FROM users WHERE ordinal < {C.CAP_N}")
    q["prefix_cap_json"] = with_q(L, f"SELECT * FROM (SELECT row_number() OVER (ORDER BY shuffle_key, rec_key) - 1 AS ordinal, instruction, output FROM labeled WHERE split = 'train') x WHERE ordinal < {C.CAP_N}")
    q["head_cap_tokenized"] = with_q(L, f"SELECT ordinal, {tok_digests()} FROM ({ordered_window('train', C.WINDOW_L)}) x WHERE ordinal < {C.HEAD_N}")
    half = max(1, C.MIX_N // 2)
    q["mix_caps"] = with_q(records({"squad": C.MIX_N, "squad_v2": half, "trivia_qa": half}), "SELECT source, count(*) AS n_records FROM records GROUP BY source")
    q["head_cap"] = with_q(L, f"SELECT ordinal, {tok_digests()} FROM ({ordered_raw('train', C.RAW_L)}) x WHERE ordinal < {C.HEAD_N}")
    q["seeded_shuffle"] = with_q(L, "SELECT rec_key, shuffle_key FROM keyed")
    q["exact_split"] = with_q(L, "SELECT rec_key, split FROM labeled")
    q["union_sources"] = with_q(R, "SELECT source, rec_key FROM records")
    q["read_qa_files"] = with_q(sources(), """SELECT source, row_md5, count(*) AS n FROM (
  SELECT source, md5(concat_ws('|', question, context)) AS row_md5 FROM squad_src
  UNION ALL SELECT source, md5(concat_ws('|', question, context)) FROM squad_v2_src
  UNION ALL SELECT source, md5(concat_ws('|', question, answer_value)) FROM trivia_src) x GROUP BY ALL""")
    q["prepare_sources"] = with_q(R, "SELECT source, md5(instruction) AS instruction_md5, md5(output) AS output_md5, count(*) AS n FROM records GROUP BY ALL")
    q["py_trim"] = (f"SELECT doc_id, {rtrim(f'text || {WS}')} = text AS rtrim_same, "
                    f"length({trim(f'{WS} || chr(8203) || text || chr(32) || chr(65279)')})::BIGINT AS n_chars FROM documents")
    q["first_nonempty_key"] = with_q(sources(), f"SELECT rec_key, {first_nonempty(*[str_at('entity_pages', f'$[0].{k}') for k in ('wiki_context', 'text', 'content')])} AS picked FROM trivia_src")
    q["find_subarray"] = with_q(R, f"""SELECT rec_key, ({find('ids', MARKER)})::BIGINT AS pos_marker,
  ({find('ids', USER_TURN)})::BIGINT AS pos_user, ({find('ids', END_THEN_MARKER)})::BIGINT AS pos_end_marker,
  ({find('ids', END_ID)})::BIGINT AS pos_end, (-1)::BIGINT AS pos_empty FROM ({tok_rows()}) x""")
    m = len(MARKER)
    q["mask_labels"] = with_q(R, f"""SELECT rec_key, {digest(f"list_concat({repeat(-100, f'pos + {m}')}, ids[pos + {m + 1} : len(ids)])")} AS labels_md5
FROM (SELECT rec_key, ids, {find('ids', MARKER)} AS pos FROM ({tok_rows()}) x) y WHERE pos >= 0""")
    q["mask_labels_keep"] = with_q(R, f"SELECT rec_key, {digest('labels')} AS labels_md5, len(list_filter(labels, lambda x: x <> -100))::BIGINT AS n_supervised FROM ({raw_of_records(C.RAW_L)}) x")
    q["truncate_head"] = with_q(R, f"SELECT rec_key, len(ids[1 : {C.TRUNCATE_L}])::BIGINT AS n_ids, {digest(f'ids[1 : {C.TRUNCATE_L}]')} AS ids_md5 FROM ({tok_rows()}) x")
    q["write_jsonl"] = with_q(L, "SELECT split, instruction, output FROM labeled")
    q["stream_prepare"] = q["prepare_sources"]
    q["split_tokens"] = with_q(R, f"SELECT rec_key, len(t)::BIGINT AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT rec_key, {tokens_of(text_of())} AS t FROM records) x")
    q["encode_ids"] = with_q(R, f"SELECT rec_key, len(ids)::BIGINT AS n_ids, {digest('ids')} AS ids_md5 FROM ({tok_rows()}) x")
    q["encode_raw_path"] = with_q(R, f"SELECT {tok_digests('rec_key')} FROM ({raw_of_records(2048)}) x")
    pad = PAD_ID
    padded = f"""SELECT ordinal, batch_id, width,
  list_concat(input_ids, {repeat(pad, 'width - len(input_ids)')}) AS p_ids,
  list_concat(attention_mask, {repeat(0, 'width - len(input_ids)')}) AS p_mask,
  list_concat(labels, {repeat(-100, 'width - len(input_ids)')}) AS p_labels
FROM (SELECT *, (ceil(max(len(input_ids)) OVER (PARTITION BY batch_id) / 8.0) * 8)::INTEGER AS width
      FROM (SELECT *, ordinal // 2 AS batch_id FROM ({ordered_raw('train', C.RAW_L)}) a) b) c"""
    q["pad_batches"] = with_q(L, f"SELECT ordinal, batch_id, width, {digest('p_ids')} AS ids_md5, {digest('p_mask')} AS mask_md5, {digest('p_labels')} AS labels_md5 FROM ({padded}) d")
    q["fit_vocab"] = with_q(R + vocab_sql(C.VOCAB_N), "SELECT token, id, count FROM vocab")
    q["encode_vocab"] = with_q(R + vocab_sql(C.VOCAB_N), """SELECT rec_key, len(ids)::BIGINT AS n_ids, md5(array_to_string(ids, ',')) AS ids_md5 FROM (
  SELECT p.rec_key, list(coalesce(v.id, -1) ORDER BY p.pos) AS ids
  FROM (SELECT rec_key, unnest(toks) AS token, unnest(range(1, len(toks) + 1)) AS pos FROM toks) p
  LEFT JOIN vocab v ON v.token = p.token GROUP BY p.rec_key) x""")
    q["pretokenize_split"] = with_q(L, f"""SELECT 'train' AS split, {tok_digests()} FROM ({window_path(split_src('train'), 'rec_key', C.WINDOW_L)}) a
UNION ALL SELECT 'val' AS split, {tok_digests()} FROM ({window_path(split_src('val'), 'rec_key', C.WINDOW_L)}) b""")
    q["stream_tokenize"] = with_q(L, f"SELECT {tok_digests()} FROM ({window_path(split_src('train'), 'rec_key', C.WINDOW_L)}) a")
    q["split_metadata"] = with_q(L, f"""SELECT count(*) AS num_total, count(*) FILTER (WHERE split = 'train') AS num_train,
  count(*) FILTER (WHERE split = 'val') AS num_val, 'squad,squad_v2,trivia_qa' AS include, {C.SEED}::BIGINT AS seed,
  {lit(SYSTEM_PROMPT)} AS system FROM labeled""")
    q["write_tokenized"] = with_q(L, " UNION ALL ".join(f"SELECT '{s}' AS split, ordinal, {tok_digests()} FROM ({ordered_window(s, C.WINDOW_L)}) {s}_rows" for s in ("train", "val")))
    q["save_mode"] = with_q(R, "SELECT 'errorifexists' AS mode, 'refused' AS second_write, count(*) AS n_rows FROM records")
    return q


ORACLE_SQL = build()
