"""Two processors at once, each with its own topic and throttle (1000 and
500 messages per fetch), one driver thread each."""

from _common import setup, show_batch

from loglake.streaming.processor import Processor, Runner, TopicController

if __name__ == "__main__":
    spark, log, store = setup()
    runner = Runner()
    runner.add(Processor(log, store, TopicController("alerts", "click", 1000), show_batch("p1"),
                         reset="earliest", name="p1"))
    runner.add(Processor(log, store, TopicController("alerts", "view", 500), show_batch("p2"),
                         reset="earliest", name="p2"))
    print(runner.start(stop_when_idle=True))
    spark.stop()
