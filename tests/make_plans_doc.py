"""Regenerate PLANS.md from explain() of the headline steps: python tests/make_plans_doc.py"""
import sys, re
sys.path.insert(0, '/root/repo')
from chatmill.session import local_session, scratch_path
from chatmill.plans.prepare import build_records, prepare
from chatmill.plans.pretokenize import pretokenize_frame, pretokenize_split
from chatmill.operators.split import label_split, seeded_shuffle
from chatmill.operators.encode import Tokenizer
from chatmill.sources.files import scan_jsonl
from chatmill.plans import train_data as TD
from chatmill.sources import tables
spark = local_session(8, 16)
sf = '/root/testdata/sf0.01'
out = scratch_path(spark, "plans")
prepare(spark, sf, out)
tok = Tokenizer()

from chatmill.config import PY_WHITESPACE, SYSTEM_PROMPT, SCRATCHPAD_TEXT, NO_CONTEXT_PLACEHOLDER

def simple(df):
    p = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    p = p.replace(PY_WHITESPACE, "<WS>")
    p = p.replace("<|im_start|>system\n" + SYSTEM_PROMPT + "\n<|im_end|>\n<|im_start|>user\nQuestion: ", "<PROMPT-HEAD>")
    p = p.replace("\n\nContext:\n", "<CTX>").replace("\n<|im_end|>\n<|im_start|>assistant", "<PROMPT-TAIL>")
    p = p.replace("<scratchpad>" + SCRATCHPAD_TEXT + "</scratchpad>\n<final>", "<ANSWER-HEAD>")
    p = p.replace("</final>\n<|im_end|>", "<ANSWER-TAIL>").replace(NO_CONTEXT_PLACEHOLDER, "<PLACEHOLDER>")
    p = p.replace("\x01", "\\x01")
    lines = []
    for l in p.split("\n"):
        l = re.sub(r"#\d+L?", "", l)
        l = re.sub(r"file:/tmp/checkpoints/[^\],]*", "<shared>", l)
        l = re.sub(r"/root/testdata/sf0.01/", "", l)
        l = l.replace("\n", "\\n")
        if len(l) > 160:
            l = l[:157] + "..."
        lines.append(l)
    return "\n".join(lines)

sections = [
    ("Raw-row cap (L1): user turns, first 100", tables.user_turns(spark, sf, 100)),
    ("Records, all three sources fused (default caps do not bind here)", build_records(spark, sf)),
    ("Split labelling after the cutoff search (O2)", label_split(seeded_shuffle(spark.read.parquet(f"{sf}/conversations.parquet").selectExpr("cast(conv_id as string) as rec_key")), (1 << 40, "0"))),
    ("Pretokenize frame (X6): JSONL scan -> ordinal -> window path", pretokenize_frame(scan_jsonl(spark, f"{out}/train.jsonl"), tok, 4096)),
]
folder = pretokenize_split(spark, "train", f"{out}/train.jsonl", out, tok)
sections += [
    ("Padded batches (X4): rows are padded as they pass, no exchange", TD.collate(TD.load_split(spark, folder, None, tok)[1], tok)),
    ("Head cap of a tokenized folder (L3): only files that its run index names", TD.load_split(spark, folder, None, tok, max_samples=20)[1]),
]
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
sections.append(("Cluster shape of the source joins: broadcast disabled, conversations with > 2 user turns salted",
                 tables.qa_pairs(spark, sf, pages=True, hot_rows=2)))
doc = ["# Physical plans of the headline steps", "",
       "Generated by `explain()` on `local[8]` at sf0.01 (expression ids and scratch paths elided; long lines cut).",
       "At this size Catalyst broadcasts the small tables from their size estimates; the last",
       "section disables that to show the sort-merge, salted shape a cluster gets.",
       "Read with the scale notes in README.md.", ""]
for title, df in sections:
    doc += [f"## {title}", "", "```", simple(df), "```", ""]
open('/root/repo/PLANS.md', 'w').write("\n".join(doc))
print(len(doc))
