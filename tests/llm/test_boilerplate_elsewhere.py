"""Furniture that neither the pages nor the training lines have."""

import pyarrow.parquet as pq

from movelane.llm import boilerplate
from movelane.llm.boilerplate_training import ELSEWHERE

# Written apart from ELSEWHERE; none of it is in the tables.
UNSEEN = [
    "Sign up today for our weekly newsletter and never miss a story", "Your privacy is important to us and we only use your email to send you updates", "Copyright 2024 Harbour Media. No article may be reproduced without permission.", "Download our app to read offline",
    "We use cookies and similar technologies to personalise content and ads", "Subscribe to our newsletter for free updates", "All rights reserved. Terms of service apply.", "Follow us on LinkedIn for more stories", "Log in to leave a comment", "This site is for information only and is not legal advice",
    "Register for free to continue reading this article", "Advertisement", "Share this article with friends", "Become a subscriber for unlimited access", "Contact the publisher | Terms of use | Privacy policy",
]


def test_unseen_furniture_leaves_the_body(small):
    pages = [r for r in pq.read_table(f"{small}/raw_items.parquet", columns=["headline", "body_text"]).to_pylist() if r["body_text"]][:60]
    model, kept, before, lost = boilerplate.Model.load(), 0, 0, 0
    assert not set(UNSEEN) & set(ELSEWHERE)
    for i, page in enumerate(pages):
        line = UNSEEN[i % len(UNSEEN)]
        lines = page["body_text"].split("\n")
        ends = {"top": [line, *lines], "bottom": [*lines, line]}
        plain = {lines[n] for n, s in zip(*model.decode([page["body_text"]], [page["headline"]])[0]) if s == boilerplate.BODY}
        for text in ends.values():
            body = {text[n] for n, s in zip(*model.decode(["\n".join(text)], [page["headline"]])[0]) if s == boilerplate.BODY}
            kept += line in body
            before += len(plain)
            lost += len(plain - body)
    assert kept <= 0.1 * 2 * len(pages) and lost <= 0.01 * before, (kept, lost, before)


def test_words_beyond_the_sixtieth_count():
    long = "The firm said that " + "the " * 80 + "newsletter"
    assert "w=newsletter" in boilerplate.line_features(long)[0]
    assert any(f.startswith("line=") for f in boilerplate.line_features(long)[0])
