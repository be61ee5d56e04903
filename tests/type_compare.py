"""Compare column types of every registered query with its oracle SQL."""
import os, sys
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_compare import duck

SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "float": "FLOAT", "smallint": "SMALLINT"}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    import __spark_entry__ as E
    from fareflow.session import local_session
    spark = local_session(8, 8)
    con = duck(sf)
    bad = 0
    for name, sql in sorted(E.oracle_sql().items()):
        s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
             for f in E.queries()[name](spark, sf).schema.fields}
        d = {c[0]: c[1] for c in con.execute(f"DESCRIBE {sql}").fetchall()}
        diff = {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
        if diff:
            bad += 1
            print(name, diff)
    print("type mismatches in", bad, "queries")


if __name__ == "__main__":
    main()
