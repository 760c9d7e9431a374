"""Two topics read as one dataset by one processor (group rule)."""

from _common import setup, show_batch

from loglake.streaming.processor import Processor, TopicSetController

if __name__ == "__main__":
    spark, log, store = setup()
    ctl = TopicSetController([("dashboards", "click"), ("dashboards", "view")])
    Processor(log, store, ctl, show_batch("multi"), reset="earliest").run(stop_when_idle=True)
    spark.stop()
