import pytest

from leadpulse import session


class FakeConf:
    def get(self, key, default=None):
        return default


class FakeContext:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class FakeSession:
    def __init__(self, master):
        self.conf, self.sparkContext = FakeConf(), FakeContext(master)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://x"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(ValueError):
        session.checkpoint_root(FakeSession(master))


def test_a_local_session_gets_a_folder():
    fake = FakeSession("local[4]")
    root = session.checkpoint_root(fake)
    assert fake.sparkContext.dir == root == session.checkpoint_root(fake)
