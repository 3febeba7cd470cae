"""The pipeline's stages, each against its operator's own brute-force tested result."""

import corpus_pipeline
from pageflow.llm import bpe, near_dup, quality
from pageflow.llm.common import saved


def test_every_stage_works_on_what_the_one_before_kept(llm, odd, none):
    docs, seen = odd, {}
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(llm, docs, ""), "stage")
        seen[name] = (docs, out)
        if name != "encoding":
            assert out.columns == odd.columns
        docs = out

    def ids(frame):
        return sorted(str(r[0]) for r in frame.select("doc_id").collect())

    before, after = seen["quality"]
    assert ids(after) == ids(quality.quality(before).where("kept"))
    before, after = seen["near duplicates"]
    kept = {r.doc_id for r in near_dup.near_duplicates(before).where("kept").collect()}
    assert {r.doc_id for r in after.select("doc_id").collect()} == kept
    assert after.where("doc_id is not null").select("doc_id", "text").distinct().count() == after.where("doc_id is not null").count()
    before, after = seen["personal data"]
    assert ids(before) == ids(after)
    before, after = seen["mixing"]
    assert set(ids(before)) == set(ids(after))
    before, after = seen["encoding"]
    assert sorted(map(str, bpe.encode_decode(before, bpe.default_path()).collect())) == sorted(map(str, after.collect()))


def test_the_pipeline_runs_on_nothing(llm, none, tmp_path):
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(llm, str(tmp_path)).count() == 0


def test_personal_data_in_everyday_forms_leaves_the_texts(llm, docs):
    forms = {1: ('{"a":"386-555-3733"}', '{"a":"<PHONE>"}'), 2: ("tel:386-555-3733", "tel:<PHONE>"), 3: ("phone=386-555-3733;", "phone=<PHONE>;"),
             4: ("x,386-555-3733,y", "x,<PHONE>,y"), 5: ("mailto:bob[at]example.com", "mailto:<EMAIL>"), 6: ("ip=83[.]64[.]220[.]33", "ip=<IP>"),
             7: ("write to a.b@c.org or +1 (826) 555-4081", "write to <EMAIL> or <PHONE>"), 8: ("4111111111111111", "<CARD>"),
             9: ("nothing on 2024-01-05 12:30", "nothing on 2024-01-05 12:30"), 10: ("", ""), 11: (None, None)}
    given = docs([(n, text) for n, (text, _) in forms.items()])
    out = corpus_pipeline.private(llm, given, "")
    assert out.columns == given.columns
    assert {r.doc_id: r.text for r in out.collect()} == {n: text for n, (_, text) in forms.items()}
