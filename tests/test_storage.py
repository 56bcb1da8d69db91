import pytest

from pagemill import storage


class Session:
    """A session on a cluster, as far as the folder is looked up."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = self, self
        self.master, self.folder = master, folder

    def getConf(self):
        return self

    def get(self, name, default):
        return self.folder if name == "spark.checkpoint.dir" else default


def test_folder():
    assert storage.shared_dir(Session("spark://host:7077", "hdfs://host/shared/")) == "hdfs://host/shared"
    assert storage.shared_dir(Session("local[4]")).startswith("file://") and storage.shared_dir(Session("local")) == storage.shared_dir(Session("local[*]"))
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            storage.shared_dir(Session(master))
