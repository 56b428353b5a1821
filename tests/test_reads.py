"""Whole texts are read once for the models, however many passes the split, the fits and the trees take."""

from quarry.plans import queries_learn as L
from quarry.session import read_table

SF = "/root/testdata/sf0.001"


def test_models_read_the_documents_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    inner = L.doc_features

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def features(*args):
        found = inner(*args)
        return found.mapInArrow(counted, found.schema)
    monkeypatch.setattr(L, "doc_features", features)
    fm, classes, tree, forest, test = L._doc_models(spark, SF, forest_too=False)
    assert L.C.predict(tree, test, "quality", ["doc_id"]).count() > 0
    assert seen.value <= 2 * read_table(spark, SF, "documents").count()
