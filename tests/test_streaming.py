import os
import tempfile

from charloom.plans.model import CharModel, ModelParams
from charloom.sources import files
from charloom.streaming import predict_stream


def test_stream_scores_each_file_like_batch(spark, small_corpus):
    model = CharModel.fit(small_corpus, ModelParams(ngram_order=3, max_chars_per_context=8))
    root = tempfile.mkdtemp(prefix="charloom-stream-")
    inbox = os.path.join(root, "in")
    os.makedirs(inbox)
    texts = {"a.txt": ["the ca", "", "an"], "b.txt": ["x", "and th"]}
    for name, lines in texts.items():
        with open(os.path.join(inbox, name), "w", encoding="utf-8") as h:
            h.write("\n".join(lines) + "\n")
    q = predict_stream.start(model, inbox, os.path.join(root, "out"), os.path.join(root, "ckpt"))
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(root, "out")).collect()
    for name, lines in texts.items():
        batch = files.read_inputs(spark, os.path.join(inbox, name))
        exp = {r.qid: r.pred for r in model.predict(batch).collect()}
        mine = {r.qid: r.pred for r in got if r.file.endswith(name)}
        assert mine == exp
