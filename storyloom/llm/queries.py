"""The queries of this subpackage and SQL for those that SQL can express."""

from __future__ import annotations

from storyloom.llm.decontamination import op3_template_decontamination
from storyloom.llm.filter_audit import OP11_SQL, op11_filter_audit
from storyloom.llm.language_field import op8_language_field
from storyloom.llm.language_model import op6_language_model
from storyloom.llm.near_duplicates import op5_near_duplicates
from storyloom.llm.packing import op1_best_fit_packing
from storyloom.llm.part_trie import OP13_SQL, op13_part_trie_codes
from storyloom.llm.phrase_fingerprints import op7_phrase_fingerprints
from storyloom.llm.prefix_trie import op12_prefix_trie_bpe
from storyloom.llm.sharding import op4_kd_shards
from storyloom.llm.substring_dedup import op2_substring_dedup
from storyloom.llm.token_files import op9_token_files
from storyloom.llm.toxicity import op10_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_template_decontamination": op3_template_decontamination,
    "op4_kd_shards": op4_kd_shards,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_language_model": op6_language_model,
    "op7_phrase_fingerprints": op7_phrase_fingerprints,
    "op8_language_field": op8_language_field,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_prefix_trie_bpe": op12_prefix_trie_bpe,
    "op13_part_trie_codes": op13_part_trie_codes,
}
#: Words as the contract has them.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP2 = f"""WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
o AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM d WHERE len(w) >= 13),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS k FROM o), f AS (SELECT k, min(doc_id) AS first FROM k GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM k JOIN f USING (k) WHERE first < doc_id),
every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS kept, count(*) AS n FROM every e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
_OP5 = f"""WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 2], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), same AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM same JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)), ways AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM ways UNION SELECT r.a, x.b FROM reach r JOIN ways x ON x.a = r.b), least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id"""
#: The others learn, tokenize, mask with patterns or lay out files in ways that SQL has no words for; tests/llm has plain versions.
ORACLE_SQL: dict[str, str] = {"op2_substring_dedup": _OP2, "op5_near_duplicates": _OP5, "op11_filter_audit": OP11_SQL, "op13_part_trie_codes": OP13_SQL}
