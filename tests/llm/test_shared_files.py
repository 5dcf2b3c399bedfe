"""Files in the shared folder, by path and by address."""

import numpy as np
import pytest

from tierflow.llm import shared_files as sf


@pytest.mark.parametrize("kind", ["path", "file", "spaces"])
def test_written_and_read(tmp_path, kind):
    place = tmp_path / ("a b" if kind == "spaces" else "new") / "deep" / "x.bin"
    address = str(place) if kind == "path" else place.as_uri()
    values = np.arange(5, dtype="<i8")
    with sf.open_output(address) as f:
        f.write(values.tobytes())
    assert place.read_bytes() == values.tobytes()
    with sf.open_input(address) as f:
        f.seek(8)
        assert f.read(8) == values[1:2].tobytes()
    got = sf.mapped(address, "<i8")
    assert isinstance(got, np.memmap) and got.tolist() == values.tolist()
    with sf.open_output(address) as f:
        f.write(b"")
    assert sf.mapped(address, "<i8").tolist() == []


def test_which_addresses_are_paths():
    assert sf.local_path("/a/b") == sf.local_path("file:/a/b") == sf.local_path("file:///a/b") == "/a/b"
    assert sf.local_path("hdfs://host/a") is None and sf.local_path("s3://bucket/a") is None
