"""Masking where the texts are, and by joined spans, over overlapping kinds."""

from ledgerloom.llm import pii
from ledgerloom.session import stage_table


def test_both_routes_mask_alike(spark):
    texts = ["mail 1.2.3.4@host.com now", "4111-1111-1111-1111@x.com", "+1 (555) 010-0199 and 4111 1111 1111 1111", "a@b.co a@b.co", None, "", "none here"]
    docs = stage_table(spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string"), "docs")
    one, two = (sorted(map(tuple, pii.masked(docs, broadcast_patterns=n).collect()), key=repr) for n in (200_000, -1))
    assert one == two
    assert dict((r[0], r[1]) for r in one)[0] == "mail [EMAIL] now" and dict((r[0], r[1]) for r in one)[1] == "[EMAIL]"
