import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    # Tiny inputs: interpreting a plan is faster than compiling it. test_queries.py runs with code generation.
    session = local_session(4, shuffle_partitions=2, memory="4g", spark__sql__codegen__wholeStage="false",
                            spark__sql__codegen__factoryMode="NO_CODEGEN", spark__sql__adaptive__enabled="false")
    yield session
    session.stop()
