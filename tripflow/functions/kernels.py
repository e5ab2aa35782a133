"""Arrow-batched (pandas UDF) numeric kernels.

Kept in a module without postponed annotations: ``pandas_udf`` reads the type hints.
Each kernel is a small vectorised numpy helper applied to whole Arrow batches.
"""

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.functions import pandas_udf

import tripflow.functions
from tripflow.functions.geo import geodesic_np

# Ship the kernels with the task (pickled by value): executors need not have the package
# installed or on their path.
cloudpickle.register_pickle_by_value(tripflow.functions)


def _arr(s: pd.Series):
    return s.to_numpy("float64", na_value=float("nan"))


@pandas_udf("double")
def geodesic_m_udf(lat1: pd.Series, lon1: pd.Series, lat2: pd.Series, lon2: pd.Series) -> pd.Series:
    """WGS-84 geodesic metres for each row of the batch (NaN: a coordinate is missing)."""
    return pd.Series(geodesic_np(_arr(lat1), _arr(lon1), _arr(lat2), _arr(lon2)))
