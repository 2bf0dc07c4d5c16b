from pyspark import cloudpickle

import corpus_pipeline

cloudpickle.register_pickle_by_value(corpus_pipeline)
