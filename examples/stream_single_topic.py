"""One topic, default throttle (5000 per fetch), one consumer group: fetch ->
process -> commit until the backlog is drained."""

from _common import setup, show_batch

from loglake.streaming.processor import Processor, TopicController

if __name__ == "__main__":
    spark, log, store = setup()
    p = Processor(log, store, TopicController("clicks_reader", "click"), show_batch("single"), reset="earliest",
                  on_stopped=lambda: print("stopped", flush=True))
    p.run(stop_when_idle=True)
    spark.stop()
