"""Keys behind a name, a parameter or a path are tokens of their own."""

import pytest

from pricehouse.llm import secret_scans

KEY = "wJ4lrXUtnF3MIaK7MDENGbPxRf1CYzq8LQ0vT2sE"


@pytest.mark.parametrize(
    "before, key, after",
    [
        ("AWS_SECRET_ACCESS_KEY=", KEY[:13] + "/" + KEY[13:20] + "/" + KEY[20:], ""),
        ("see https://example.org/get?sig=", KEY, "&n=1"),
        ("https://example.org/example/a-b/v1/", KEY, " end"),
        ("config/my_app/v2/key=", KEY + "==", ";"),
        ("", KEY, "=old"),
    ],
)
def test_key_is_a_token(before, key, after):
    found = {(s, e) for s, kind, e, _, step in secret_scans.spans_of(before + key + after) if kind == 3 and step < 32}
    assert (len(before), len(before) + len(key)) in found


def test_keys_are_listed_and_redacted(workers):
    text = f"AWS_SECRET_ACCESS_KEY={KEY} and example/a-b/v1/{KEY} and sig={KEY} end"
    docs = workers.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = {(s["start"], s["end"]) for s in secret_scans.find_secrets(docs).head()["spans"]}
    places = [i for i in range(len(text)) if text.startswith(KEY, i)]
    assert {(i, i + len(KEY)) for i in places} <= spans
    assert KEY not in secret_scans.redact(docs).head()["text"]
