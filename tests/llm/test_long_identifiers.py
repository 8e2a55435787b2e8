"""Identifiers of more than 64 characters end where the value ends."""

import pytest
from pyspark.sql import functions as F

from parcelight.llm import common, secret_scan
from tests.llm.test_text_operators import by_id, frame

CLIENT = "client_id=" + "1" * 12 + "-" + "q" * 32 + ".apps.googleusercontent.com"


@pytest.mark.parametrize("gap", [1, 199, 200, 201])
@pytest.mark.parametrize("identifier", [CLIENT, "user_name: " + "ab9." * 400])
def test_long_identifier(spark, identifier, gap):
    common.prepared(spark)
    text = f"see {identifier}" + " " * gap + "pwd=hunter22 end"
    docs = frame(spark, [(1, text, "en", "a")])
    end = 4 + len(identifier)
    want = f"identifier:4:{end},secret:{end + gap}:{end + gap + 12}" if gap <= 200 else ""
    assert by_id(secret_scan.secret_digest(docs))[1].spans == want
    if gap <= 200:
        spans = secret_scan.scan_secrets(docs.select("doc_id", "text"), ("doc_id", "text"))
        clean = spans.select(secret_scan.redacted(F.col("text"), F.col("spans"))).first()[0]
        assert clean == "see [IDENTIFIER]" + " " * gap + "[SECRET] end"
