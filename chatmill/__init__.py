"""chatmill: instruction-data preparation as Spark DataFrame jobs.

Public entry points (each a plain function over DataFrames / paths):

* ``plans.prepare.prepare``          QA sources -> chat records -> exact split -> JSONL
* ``plans.pretokenize.pretokenize``  JSONL -> window-cropped, label-masked token rows
* ``plans.train_data.load_split``    raw or pre-tokenized split -> capped, padded batches
"""

__version__ = "0.1.0"
