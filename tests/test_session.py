"""What the session keeps must not travel with the code sent to workers."""

import threading

from pyspark import cloudpickle

from seriesforge.plans import catalog
from seriesforge.session import session_cache


def test_functions_naming_the_catalogue_pickle_after_a_model_was_kept(spark):
    kept = catalog._once(spark, "nowhere", "unpicklable", lambda: (spark, threading.RLock()))
    assert catalog._once(spark, "nowhere", "unpicklable", lambda: None) is kept
    assert cloudpickle.loads(cloudpickle.dumps(lambda: catalog.MEDIANS["hour"]))() == 11.0
    del session_cache(spark)["nowhere", "unpicklable"]


def test_a_new_session_keeps_its_own(spark):
    session_cache(spark)["probe"] = 1
    assert "probe" not in session_cache(spark.newSession())
    del session_cache(spark)["probe"]
