"""Every query of this part has SQL, or a test that holds it against a plain model."""

from pathlib import Path

from tunemill.llm.registry import ORACLE, QUERIES

#: Query: test file, and the test that compares with brute force or a library.
PLAIN_MODELS = {
    "op1_toxicity_channel": "test_toxicity.py", "op2_simhash_pivots": "test_simhash.py",
    "op3_pieces_viterbi": "test_pieces.py", "op4_benchmark_containment": "test_contain.py",
    "op5_line_similarity": "test_lines.py", "op7_token_counts": "test_tokens.py",
    "op9_url_model_ratio": "test_urls.py", "op10_secret_network": "test_secrets.py",
}


def test_every_query_has_sql_or_a_plain_model():
    assert set(QUERIES) == set(ORACLE) | set(PLAIN_MODELS)
    assert not set(ORACLE) & set(PLAIN_MODELS)
    for name in PLAIN_MODELS.values():
        assert "def test_" in (Path(__file__).parent / name).read_text()


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
