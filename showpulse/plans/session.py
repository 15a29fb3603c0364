"""Session settings the operators are written for. Apply them when the session is built; the library sets none."""

SETTINGS = {
    # Times of stored rows and message texts are read and written in one zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime sizes decide the number of shuffle partitions and the join strategies.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stream state lives on local disk with its changes in the checkpoint, so it may outgrow memory and survives
    # the loss of an executor.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sessions of one key meet before the shuffle as well as after it.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
