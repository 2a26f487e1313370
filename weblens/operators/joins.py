"""Joins with reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame

EMP_DEPT_SQL = "SELECT d.dname, e.* FROM {emp} e JOIN {dept} d ON e.deptno = d.deptno"


def join_emp_dept(emp: DataFrame, dept: DataFrame) -> DataFrame:
    """``dname`` and all columns of ``emp``. Either side may come from the catalog, JDBC or files.

    No hint: Spark broadcasts ``dept`` while its size is below the threshold, and joins by shuffle with
    AQE's skew handling beyond it.
    """
    return emp.sparkSession.sql(EMP_DEPT_SQL, emp=emp, dept=dept)
