"""Suffix dedup takes the runs of every text once."""

import hashlib

from railmart.llm import suffixes


def test_runs_of_a_text_are_taken_once(texts, tmp_path, monkeypatch):
    seen = str(tmp_path / "seen")
    taken = suffixes.runs_in

    def noted(docs, length):
        def note(batches):
            for batch in batches:
                with open(seen, "a") as f:
                    f.write("x" * batch.num_rows)
                yield batch

        return taken(docs.mapInArrow(note, docs.schema), length)

    monkeypatch.setattr(suffixes, "runs_in", noted)
    passage = "".join(hashlib.sha256(bytes([i])).hexdigest() for i in range(4))
    rows = [(1, passage), (2, f"before {passage} behind"), (3, "short"), (4, "x" * 300), (5, None)]
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffixes.dedup(texts(rows), length=100).collect()}
    assert found == {1: (256, 1), 2: (256, 1), 3: (0, 0), 4: (300, 1), 5: (0, 0)}
    assert len(open(seen).read()) == len(rows)
