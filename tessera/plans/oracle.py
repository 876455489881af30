"""DuckDB SQL for the rows of the catalogue's queries, put together from common table expressions."""

from __future__ import annotations

from ..functions.text import LEGAL_FORMS, STREET_WORDS
from ..operators.blocking import GENERIC_ADDRESS_TOKENS

CAP, LIMIT, NUMBERS, NEGATIVES = 500, 50, 100, 50_000


def p2(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower(strip_accents(coalesce({x}, ''))), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def legal(x: str) -> str:
    for a, b in sorted(LEGAL_FORMS.items(), key=lambda kv: -len(kv[0])):
        x = rf"regexp_replace({x}, '\b{a}\b', '{b}', 'g')"
    return x


def street(x: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in STREET_WORDS.items())
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"


def words(x: str) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def all_words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def grams(x: str, sizes: tuple[int, ...]) -> str:
    p = f"('  ' || {x} || '  ')"
    lists = [f"list_transform(range(1, length({p}) - {n} + 2), lambda i: substr({p}, i, {n}))" for n in sizes]
    return "list_distinct(" + (lists[0] if len(lists) == 1 else f"flatten([{', '.join(lists)}])") + ")"


# The patterns of numbers, postal codes and units in these expressions.
ENT = r"""ent AS (
    SELECT 'S' || sno || '-' || repeat('0', greatest(0, 6 - length(doc_id::VARCHAR))) || doc_id AS entity_id, array_to_string(tk[1:4], ' ') AS business_name,
           n_chars || ' ' || array_to_string(tk[5:12], ' ') AS business_address, lang AS country, 'source' || sno AS record_source, array_to_string(tk[13:18], ' ') AS truth_key
    FROM (SELECT doc_id, n_chars, lang, regexp_extract(source, '([0-9]+)', 1)::INT % 3 + 1 AS sno,
                 list_filter(string_split(lower(regexp_replace(text, '[^a-zA-Z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS tk FROM documents))"""
NORM = rf""", norm AS (
    SELECT *, coalesce(regexp_extract_all(an, '\b[0-9]+[a-z]?\b')[1], '') AS house, coalesce(regexp_extract_all(an, '\b[0-9]{{4,10}}\b')[-1], '') AS postal,
           regexp_extract_all(an, '\b[0-9]+[a-z]?\b') AS nums, regexp_extract(an, '\b(?:apt|apartment|unit|suite|ste|floor|fl)\s*([\w-]+)', 1) AS unit
    FROM (SELECT *, {legal(p2('business_name'))} AS nn, {street(p2('business_address'))} AS an, {p2('country')} AS cn FROM ent)),
    q AS (SELECT * FROM norm WHERE record_source = 'source1'), r AS (SELECT * FROM norm WHERE record_source <> 'source1')"""
SQLNORM = r""", sr AS (
    SELECT *, regexp_extract(an, '(^| )([0-9]+[a-z]?)', 2) AS house, regexp_extract(an, '([0-9]{4,10})', 1) AS postal FROM (
        SELECT *, lower(strip_accents(regexp_replace(coalesce(business_name, ''), '[^[:alnum:][:space:]]+', ' ', 'g'))) AS nn,
               lower(strip_accents(regexp_replace(coalesce(business_address, ''), '[^[:alnum:][:space:]]+', ' ', 'g'))) AS an, lower(trim(coalesce(country, ''))) AS cn
        FROM ent WHERE record_source <> 'source1'))"""


def keyed(name: str, frame: str, kinds: dict[str, str]) -> str:
    """A postings expression: kind, country, key, entity_id."""
    parts = " UNION ALL ".join(f"SELECT '{k}' AS kind, cn AS country, unnest({x}) AS key, entity_id FROM {frame}" for k, x in kinds.items())
    return f", {name} AS (SELECT * FROM ({parts}) WHERE key IS NOT NULL AND key <> '')"


KINDS = {
    "name_exact": "[nn]", "address_exact": "[an]", "name_address_exact": "[CASE WHEN nn <> '' AND an <> '' THEN nn || chr(1) || an END]", "house": "[house]", "postal": "[postal]",
    "name_token": words("nn"), "address_token": words("an"), "name_gram": f"CASE WHEN nn <> '' THEN {grams('nn', (3, 4, 5))} ELSE [] END", "address_gram": f"CASE WHEN an <> '' THEN {grams('an', (3, 4, 5))} ELSE [] END",
}


def some(*kinds: str) -> dict[str, str]:
    return {k: KINDS[k] for k in kinds}


def capped(name: str, posted: str, exact: int | None) -> str:
    rule = f"nth <= CASE WHEN kind LIKE '%exact' THEN {exact or 1 << 40} WHEN kind IN ('house', 'postal') THEN {NUMBERS} ELSE {LIMIT} END"
    return f", {name} AS (SELECT kind, country, key, entity_id FROM (SELECT *, row_number() OVER (PARTITION BY kind, country, key ORDER BY entity_id) AS nth FROM {posted}) WHERE {rule})"


MET = "SELECT DISTINCT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id FROM {} a JOIN {} b USING (kind, country, key)"
SMALLEST = f"SELECT source1_entity_id, candidate_entity_id FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY candidate_entity_id) AS nth FROM met) WHERE nth <= {CAP}"


def priority(ref: str, cap: int = CAP, name: str = "cand") -> str:
    return f""", {name} AS (
    SELECT source1_entity_id, candidate_entity_id FROM (
        SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY priority, candidate_entity_id) AS nth FROM (
            SELECT source1_entity_id, candidate_entity_id, min(priority) AS priority FROM (
                SELECT q.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, 1 AS priority FROM q JOIN {ref} b USING (cn)
                WHERE (q.nn <> '' AND q.nn = b.nn) OR (q.an <> '' AND q.an = b.an) OR (q.house <> '' AND q.house = b.house) OR (q.postal <> '' AND q.postal = b.postal)
                UNION SELECT q.entity_id, t.entity_id, 2 FROM q JOIN (SELECT entity_id, cn, unnest(string_split(nn, ' ')) AS token FROM {ref} WHERE nn <> '') t ON q.cn = t.cn AND list_contains(string_split(q.nn, ' '), t.token) WHERE q.nn <> ''
                UNION SELECT q.entity_id, t.entity_id, 3 FROM q JOIN (SELECT entity_id, cn, unnest(string_split(an, ' ')) AS token FROM {ref} WHERE an <> '') t ON q.cn = t.cn AND list_contains(string_split(q.an, ' '), t.token) WHERE q.an <> '')
            GROUP BY ALL)) WHERE nth <= {cap})"""


TRUTH = """, truth AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id FROM ent a JOIN ent b USING (country, truth_key)
    WHERE a.record_source = 'source1' AND b.record_source <> 'source1' AND truth_key <> '')"""
BASE = f"WITH {ENT}{NORM}"
CAND = BASE + priority("r")
SIDES = "FROM {} c JOIN q ON q.entity_id = c.source1_entity_id JOIN r ON r.entity_id = c.candidate_entity_id"


def jaccard(a: str, b: str) -> str:
    return f"(CASE WHEN len(list_distinct({a} || {b})) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct({a} || {b})) END)"


def cosine(a: str, b: str) -> str:
    wa, wb = all_words(a), all_words(b)
    count = lambda w, t: f"len(list_filter({w}, lambda y: y = {t}))::DOUBLE"
    dot = f"list_sum(list_transform(list_distinct({wa}), lambda t: {count(wa, 't')} * {count(wb, 't')}))"
    norm = lambda w: f"sqrt(list_sum(list_transform(list_distinct({w}), lambda t: {count(w, 't')} * {count(w, 't')})))"
    return f"(CASE WHEN len({wa}) = 0 AND len({wb}) = 0 THEN 1.0::DOUBLE WHEN len({wa}) = 0 OR len({wb}) = 0 THEN 0.0 ELSE {dot} / ({norm(wa)} * {norm(wb)}) END)"


def feature(**columns: str) -> str:
    return f"{CAND} SELECT source1_entity_id, candidate_entity_id, " + ", ".join(f"round(({x})::DOUBLE, 6) AS {k}" for k, x in columns.items()) + " " + SIDES.format("cand")


def indel(a: str, b: str, name: str) -> str:
    """The ratio by a recursive bit-parallel LCS over the distinct pairs of texts."""
    return f"""WITH RECURSIVE {ENT}{NORM}{priority("r")}, c AS (SELECT source1_entity_id, candidate_entity_id, {a} AS a, {b} AS b {SIDES.format("cand")}),
    p AS (SELECT DISTINCT a, b FROM c),
    l(a, b, i, s) AS (SELECT a, b, 0, ((1::HUGEINT << length(b)) - 1)::HUGEINT FROM p
        UNION ALL SELECT a, b, i + 1, (((s + u) | (s - u)) & ((1::HUGEINT << length(b)) - 1))::HUGEINT FROM (
            SELECT a, b, i, s, s & coalesce(list_sum(list_transform(range(1, length(b) + 1), lambda j: CASE WHEN substr(b, j, 1) = substr(a, i + 1, 1) THEN 1::HUGEINT << (j - 1)::INT ELSE 0::HUGEINT END)), 0)::HUGEINT AS u
            FROM l WHERE i < length(a)))
    SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN length(c.a) + length(c.b) = 0 THEN 1.0 ELSE 2.0 * (length(c.b) - bit_count(s)) / (length(c.a) + length(c.b)) END::DOUBLE, 6) AS {name}
    FROM c JOIN l ON c.a = l.a AND c.b = l.b AND l.i = length(c.a)"""


SCORED = CAND + TRUTH + f""", scored AS (SELECT source1_entity_id, candidate_entity_id, round(({jaccard(words('q.nn'), words('r.nn'))} + {jaccard(words('q.an'), words('r.an'))}) / 2, 6) AS match_probability {SIDES.format('cand')})"""
SWEEP = SCORED + """, th AS (SELECT unnest(range(30, 100, 5)) / 100.0::DOUBLE AS threshold),
    hits AS (SELECT threshold, s.source1_entity_id, count(*) AS n_pred, count(t.candidate_entity_id) AS n_hit FROM scored s JOIN th ON s.match_probability >= threshold
        LEFT JOIN truth t ON t.source1_entity_id = s.source1_entity_id AND t.candidate_entity_id = s.candidate_entity_id GROUP BY ALL),
    trues AS (SELECT source1_entity_id, count(*) AS n_true FROM truth GROUP BY ALL),
    counts AS (SELECT e.threshold, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(n_hit, 0) AS n_hit
        FROM (SELECT entity_id, threshold FROM ent CROSS JOIN th WHERE record_source = 'source1') e
        LEFT JOIN hits h ON h.threshold = e.threshold AND h.source1_entity_id = e.entity_id LEFT JOIN trues t ON t.source1_entity_id = e.entity_id),
    pr AS (SELECT *, CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE WHEN n_pred = 0 THEN 0.0 ELSE n_hit / n_pred END AS p, CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE ELSE n_hit / n_true END AS r FROM counts),
    sweep AS (SELECT threshold, round(avg(CASE WHEN n_true = 0 THEN p WHEN p = 0 AND r = 0 THEN 0.0 ELSE 1.25 * p * r / (0.25 * p + r) END), 6) AS macro_f0_5, round(avg(p), 6) AS macro_precision, round(avg(r), 6) AS macro_recall,
        round(avg((n_true = 0 AND n_pred = 0)::INT::DOUBLE), 6) AS singleton_accuracy, sum(n_pred)::DOUBLE AS predicted_matches, count(*)::DOUBLE AS entities FROM pr GROUP BY threshold)"""
LABELLED = CAND + TRUTH + ", lab AS (SELECT c.*, (t.candidate_entity_id IS NOT NULL)::INT::DOUBLE AS target FROM cand c LEFT JOIN truth t USING (source1_entity_id, candidate_entity_id))"


def stats(all_entities: bool) -> str:
    counts = "SELECT e.entity_id, count(c.candidate_entity_id) AS n FROM (SELECT entity_id FROM ent WHERE record_source = 'source1') e LEFT JOIN cand c ON c.source1_entity_id = e.entity_id GROUP BY ALL"
    return f"""{CAND} SELECT round(avg(n), 6) AS average_candidates, round(median(n)::DOUBLE, 6) AS median_candidates, max(n)::DOUBLE AS maximum_candidates,
        round(1 - sum(n)::DOUBLE / ((SELECT count(*) FROM q)::DOUBLE * (SELECT count(*) FROM r)), 6) AS candidate_reduction_ratio FROM ({counts}) {"" if all_entities else "WHERE n > 0"}"""


def single(kind: str) -> str:
    text = BASE + keyed("a", "q", some(kind)) + keyed("b0", "r", some(kind))
    text += capped("b", "b0", None) if kind.endswith("gram") else ", b AS (SELECT * FROM b0)"
    return f"{text} {MET.format('a', 'b')}"


def joined(frame: str, name: str) -> str:
    return f"SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(DISTINCT x.candidate_entity_id, ',' ORDER BY x.candidate_entity_id), '') AS {name} FROM (SELECT entity_id FROM ent WHERE record_source = 'source1') e LEFT JOIN {frame} x ON x.source1_entity_id = e.entity_id GROUP BY e.entity_id"


REF = "(SELECT entity_id, business_name, business_address, country, record_source FROM ent WHERE record_source <> 'source1')"
INVERTED = ("name_exact", "address_exact", "name_address_exact", "house", "postal", "name_token", "address_token")
STOP = ", ".join(f"'{w}'" for w in GENERIC_ADDRESS_TOKENS)
RAW = "(SELECT doc_id, text AS raw FROM documents)"

ORACLE_SQL: dict[str, str] = {
    "entity_projection": f"WITH {ENT} SELECT * FROM ent",
    "reference_union": f"WITH {ENT} SELECT * FROM {REF}",
    "profile_rows_nulls": f"WITH {ENT} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) - count({c}) AS n_nulls FROM {REF}" for c in ("entity_id", "business_name", "business_address", "country", "record_source")),
    "profile_country_counts": f"WITH {ENT} SELECT country, count(*) AS n_rows FROM {REF} GROUP BY country",
    "truth_parse": f"WITH {ENT}{TRUTH} SELECT * FROM truth",
    "normalize_text": f"SELECT doc_id, {p2('raw')} AS normalized FROM {RAW}",
    "normalize_name": f"SELECT doc_id, {legal(p2('raw'))} AS normalized FROM {RAW}",
    "normalize_address": f"SELECT doc_id, {street(p2('raw'))} AS normalized FROM {RAW}",
    "sql_normalize_asymmetric": f"WITH {ENT}{SQLNORM} SELECT entity_id, nn AS name_normalized, an AS address_normalized, cn AS country_normalized, house AS house_number, postal AS postal_code FROM sr",
    "extract_numeric": f"{BASE} SELECT entity_id, array_to_string(nums, ',') AS numbers FROM r",
    "extract_postal": f"{BASE} SELECT entity_id, postal AS postal_code FROM r",
    "extract_house": f"{BASE} SELECT entity_id, house AS house_number FROM r",
    "extract_unit": f"{BASE} SELECT entity_id, unit AS unit_number FROM r",
    "char_ngrams": f"{BASE} SELECT entity_id, unnest({grams('nn', (3, 4, 5))}) AS gram FROM r",
    "token_postings": BASE + keyed("p", "r", some("name_token", "address_token")) + " SELECT * FROM p",
    "postings_capped": BASE + keyed("p", "r", some("name_token", "address_token", "house")) + capped("c", "p", None) + " SELECT * FROM c",
    "block_exact_name": single("name_exact"), "block_exact_address": single("address_exact"), "block_exact_name_address": single("name_address_exact"), "block_house": single("house"), "block_postal": single("postal"),
    "block_name_tokens": single("name_token"), "block_address_tokens": single("address_token"), "block_name_ngrams": single("name_gram"), "block_address_ngrams": single("address_gram"),
    "block_inverted": BASE + keyed("a", "q", KINDS) + keyed("b0", "r", KINDS) + capped("b", "b0", None) + f", met AS ({MET.format('a', 'b')}) {SMALLEST}",
    "block_disk_stopwords": BASE + keyed("a0", "q", some(*INVERTED)) + f", a AS (SELECT * FROM a0 WHERE kind <> 'address_token' OR (length(key) > 2 AND key NOT IN ({STOP})))" + keyed("b0", "r", some(*INVERTED)) + capped("b", "b0", CAP) + f", met AS ({MET.format('a', 'b')}) {SMALLEST}",
    "block_priority": f"{CAND} SELECT * FROM cand",
    "block_priority_asymmetric": BASE + SQLNORM + priority("sr") + " SELECT * FROM cand",
    "blocking_stats_all": stats(True), "blocking_stats_nonzero": stats(False),
    "blocking_recall": f"{CAND}{TRUTH} SELECT round(avg(covered), 6) AS candidate_recall FROM (SELECT e.entity_id, coalesce(min((c.candidate_entity_id IS NOT NULL OR t.candidate_entity_id IS NULL)::INT), 1)::DOUBLE AS covered FROM (SELECT entity_id FROM ent WHERE record_source = 'source1') e LEFT JOIN truth t ON t.source1_entity_id = e.entity_id LEFT JOIN cand c ON c.source1_entity_id = t.source1_entity_id AND c.candidate_entity_id = t.candidate_entity_id GROUP BY ALL)",
    "fetch_records_semi": f"{CAND} SELECT * FROM {REF} WHERE entity_id IN (SELECT candidate_entity_id FROM cand)",
    "negatives_anti": f"WITH {ENT}{TRUTH}, n AS (SELECT *, row_number() OVER (PARTITION BY record_source ORDER BY entity_id) AS nth FROM {REF} WHERE entity_id NOT IN (SELECT candidate_entity_id FROM truth)) SELECT * FROM {REF} WHERE entity_id IN (SELECT candidate_entity_id FROM truth) UNION ALL SELECT entity_id, business_name, business_address, country, record_source FROM n WHERE nth <= {NEGATIVES}",
    "feat_token_jaccard": feature(name_token_jaccard=jaccard(words("q.nn"), words("r.nn")), address_token_jaccard=jaccard(words("q.an"), words("r.an"))),
    "feat_char_jaccard": feature(name_character_similarity=jaccard(grams("q.nn", (3,)), grams("r.nn", (3,))), address_character_similarity=jaccard(grams("q.an", (3,)), grams("r.an", (3,)))),
    "feat_cosine": feature(name_tfidf_cosine=cosine("q.nn", "r.nn"), address_tfidf_cosine=cosine("q.an", "r.an"), combined_tfidf_cosine=cosine("(q.nn || ' ' || q.an)", "(r.nn || ' ' || r.an)")),
    "feat_numeric": feature(numeric_token_overlap=jaccard("list_distinct(q.nums)", "list_distinct(r.nums)")),
    "feat_flags": feature(country_match="(q.cn = r.cn)::INT", exact_number_match="(q.house <> '' AND q.house = r.house)::INT", postal_code_match="(q.postal <> '' AND q.postal = r.postal)::INT"),
    "feat_length": feature(name_length_difference="abs(length(q.nn) - length(r.nn))", address_length_difference="abs(length(q.an) - length(r.an))"),
    "feat_indel": indel("q.nn", "r.nn", "name_levenshtein_similarity"),
    "feat_token_sort": indel(f"array_to_string(list_sort({words('q.nn')}), ' ')", f"array_to_string(list_sort({words('r.nn')}), ' ')", "name_token_sort_ratio"),
    "label_pairs": f"{LABELLED} SELECT * FROM lab",
    "group_split": f"{LABELLED} SELECT *, CASE WHEN ('0x' || substr(md5(source1_entity_id || '/42'), 1, 8))::UBIGINT % 10000 < 2000 THEN 'held' ELSE 'fit' END AS part FROM lab",
    "negatives_top5": f"{LABELLED} SELECT source1_entity_id, candidate_entity_id, target FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, target ORDER BY candidate_entity_id) AS nth FROM lab) WHERE target = 1 OR nth <= 5",
    "class_balance": f"{LABELLED} SELECT count(DISTINCT target) AS n_classes, count(*) FILTER (target = 1) AS n_positive, count(*) FILTER (target = 0) AS n_negative, round(least(count(*) FILTER (target = 0) / greatest(1, count(*) FILTER (target = 1)), 10.0)::DOUBLE, 6) AS positive_weight FROM lab",
    "rule_score_threshold": f"{SCORED} SELECT * FROM scored WHERE match_probability >= 0.3",
    "threshold_sweep": f"{SWEEP} SELECT * FROM sweep",
    "eval_macro_f05": f"{SWEEP} SELECT * EXCLUDE (threshold) FROM sweep WHERE round(threshold, 2) = 0.3",
    "best_threshold": f"{SWEEP} SELECT * FROM sweep ORDER BY macro_f0_5 DESC, threshold LIMIT 1",
    "submission_candidates": f"{CAND} {joined('cand', 'candidate_entity_ids')}",
    "submission_matches": f"{SCORED} {joined('(SELECT * FROM scored WHERE match_probability >= 0.3)', 'matched_entity_ids')}",
}
