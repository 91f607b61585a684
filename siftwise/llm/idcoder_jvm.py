'''idcoder's steps in the JVM: the same integers in the same order, so the same bytes, a block at a time and compiled.

The source below is compiled by Janino, the compiler that Spark brings along, and goes to the executors as a jar that Spark
itself distributes; no other compiler or file is needed. Where the session has no JVM of its own to reach (Spark
Connect), there is no such coder, and idcoder.py does the work: slower, same files.
'''

from __future__ import annotations

import os
import shutil
import tempfile
import zipfile

import numpy as np
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from siftwise.llm import idcoder

PACKAGE = "siftwise.llm.idcoder"
SOURCE = r"""
package siftwise.llm.idcoder;

import java.io.ByteArrayOutputStream;
import java.util.zip.CRC32;
import org.apache.spark.sql.Row;
import org.apache.spark.sql.RowFactory;
import org.apache.spark.sql.api.java.UDF1;
import org.apache.spark.sql.api.java.UDF4;

/** Streams of blocks: ids, words, crc32 of the ids, then the words; a WIDE block is followed by its high halves. */
public class Blocks implements java.io.Serializable {
    static final int BLOCK = 2048, HEADER = 12, WIDE = 1 << 31;
    /** 4,096 numbers of STRETCH, then 4,095 of SQUASH, little-endian. */
    private byte[] tables;

    public void setTables(byte[] given) { tables = given; }

    Lane lane() { return new Lane(tables); }

    static int get(byte[] from, int at) {
        return from[at] & 255 | (from[at + 1] & 255) << 8 | (from[at + 2] & 255) << 16 | from[at + 3] << 24;
    }

    static void put(byte[] to, int at, int value) {
        to[at] = (byte) value;
        to[at + 1] = (byte) (value >> 8);
        to[at + 2] = (byte) (value >> 16);
        to[at + 3] = (byte) (value >> 24);
    }

    static int crc(byte[] of, int at, int bytes) {
        CRC32 crc = new CRC32();
        crc.update(of, at, bytes);
        return (int) crc.getValue();
    }

    byte[] encode(byte[] raw) {
        ByteArrayOutputStream out = new ByteArrayOutputStream(raw.length / 2 + 64);
        Lane lane = lane();
        int[] ids = new int[BLOCK];
        for (int at = 0; at < raw.length; at += 4 * BLOCK) {
            int n = Math.min(BLOCK, (raw.length - at) / 4), high = 0;
            for (int k = 0; k < n; k++) {
                int id = get(raw, at + 4 * k);
                ids[k] = id & 65535;
                high |= id >>> 16;
            }
            int crc = crc(raw, at, 4 * n);
            write(out, n | (high == 0 ? 0 : WIDE), crc, lane, ids, n);
            if (high != 0) {
                for (int k = 0; k < n; k++) ids[k] = get(raw, at + 4 * k) >>> 16;
                write(out, n, crc, lane, ids, n);
            }
        }
        return out.toByteArray();
    }

    private static void write(ByteArrayOutputStream out, int mark, int crc, Lane lane, int[] ids, int n) {
        lane.start(null, 0, 0);
        lane.run(ids, n);
        lane.finish();
        byte[] bytes = new byte[HEADER + 4 * lane.at];
        put(bytes, 0, mark);
        put(bytes, 4, lane.at);
        put(bytes, 8, crc);
        for (int k = 0; k < lane.at; k++) put(bytes, HEADER + 4 * k, lane.words[k]);
        out.write(bytes, 0, bytes.length);
    }

    byte[] decode(byte[] data) {
        long total = 0;
        for (int at = 0; at < data.length; at += HEADER + 4 * get(data, at + 4)) {
            int n = get(data, at);
            total += n & ~WIDE;
            if ((n & WIDE) != 0) {
                at += HEADER + 4 * get(data, at + 4);
            }
        }
        byte[] raw = new byte[Math.toIntExact(4 * total)];
        Lane lane = lane();
        int[] ids = new int[BLOCK];
        int to = 0;
        for (int at = 0; at < data.length;) {
            boolean wide = (get(data, at) & WIDE) != 0;
            int n = get(data, at) & ~WIDE, crc = get(data, at + 8);
            if (n > ids.length) ids = new int[n];
            for (int half = 0; half < (wide ? 2 : 1); half++) {
                int words = get(data, at + 4);
                lane.start(data, at + HEADER, words);
                lane.run(ids, n);
                at += HEADER + 4 * words;
                for (int k = 0; k < n; k++) put(raw, to + 4 * k, half == 0 ? ids[k] : get(raw, to + 4 * k) | ids[k] << 16);
            }
            if (crc(raw, to, 4 * n) != crc) throw new IllegalArgumentException("checksum of the block that ends at byte " + at + " fails");
            to += 4 * n;
        }
        return raw;
    }

    /** Ids (little-endian 32-bit) to a stream. */
    public static class Encode extends Blocks implements UDF1 {
        public Object call(Object raw) { return encode((byte[]) raw); }
    }

    /** A stream to ids. */
    public static class Decode extends Blocks implements UDF1 {
        public Object call(Object data) { return decode((byte[]) data); }
    }

    /** base, doc_ids, lengths and the stream of a segment to its documents: doc_id, start, n_tokens, ids. */
    public static class Documents extends Blocks implements UDF4 {
        public Object call(Object base, Object docIds, Object lengths, Object data) {
            scala.collection.Seq ids = (scala.collection.Seq) docIds, n = (scala.collection.Seq) lengths;
            byte[] raw = decode((byte[]) data);
            Object[] out = new Object[n.length()];
            scala.collection.Iterator id = ids.iterator(), next = n.iterator();
            long first = ((Long) base).longValue(), at = 0;
            for (int k = 0; k < out.length; k++) {
                long length = ((Long) next.next()).longValue();
                if (4 * (at + length) > raw.length) break;
                byte[] own = new byte[(int) (4 * length)];
                System.arraycopy(raw, (int) (4 * at), own, 0, own.length);
                out[k] = RowFactory.create(new Object[] {id.next(), Long.valueOf(first + at), Long.valueOf(length), own});
                at += length;
            }
            if (4 * at != raw.length || (out.length > 0 && out[out.length - 1] == null)) throw new IllegalArgumentException("a segment's lengths and ids differ");
            return out;
        }
    }

    /** The chance that the prediction of one order is right. */
    static class Mixed {
        final int[] byConfidence = new int[16], byHistory = new int[16], stretch, squash;
        int history, w1, w2, i, p1, p2, s1, s2, p;

        Mixed(int[] stretch, int[] squash) {
            this.stretch = stretch;
            this.squash = squash;
        }

        void start() {
            java.util.Arrays.fill(byConfidence, 16384);
            java.util.Arrays.fill(byHistory, 16384);
            history = 0;
            w1 = w2 = 32768;
        }

        int chance(int confidence) {
            i = confidence;
            p1 = byConfidence[i];
            p2 = byHistory[history];
            s1 = stretch[p1 >> 4];
            s2 = stretch[p2 >> 4];
            int x = (s1 * (w1 >> 4) + s2 * (w2 >> 4)) >> 12;
            p = squash[Math.max(-2047, Math.min(2047, x)) + 2047];
            return p;
        }

        void learn(boolean hit) {
            int goal = hit ? 65504 : 32, error = (goal - p) >> 4;
            w1 = Math.max(-131072, Math.min(262144, w1 + ((error * s1) >> 9)));
            w2 = Math.max(-131072, Math.min(262144, w2 + ((error * s2) >> 9)));
            byConfidence[i] = p1 + ((goal - p1) >> 4);
            byHistory[history] = p2 + ((goal - p2) >> 4);
            history = (history * 2 + (hit ? 1 : 0)) & 15;
        }
    }

    /** One block's interval [a, b], unsigned, and its model. */
    static class Lane {
        static final int SLOTS_1 = 512, SLOTS_2 = 1024, TOTAL = SLOTS_2 + SLOTS_1 + 1;
        final Mixed m0, m1, m2;
        final int[] known = new int[TOTAL], sure = new int[TOTAL], first = new int[16], second = new int[256];
        int[] words = new int[BLOCK / 2 + 64];
        byte[] in;
        int from, given, at;
        long a, b, x;

        Lane(byte[] tables) {
            int[] stretch = new int[4096], squash = new int[4095];
            for (int k = 0; k < stretch.length; k++) stretch[k] = get(tables, 4 * k);
            for (int k = 0; k < squash.length; k++) squash[k] = get(tables, 4 * (4096 + k));
            m0 = new Mixed(stretch, squash);
            m1 = new Mixed(stretch, squash);
            m2 = new Mixed(stretch, squash);
        }

        /** in: the bytes that are read, null to write. */
        void start(byte[] in, int from, int given) {
            java.util.Arrays.fill(known, 0);
            java.util.Arrays.fill(sure, 0);
            for (int k = 0; k < 16; k++) first[k] = k << 12;
            for (int k = 0; k < 256; k++) second[k] = (k & 15) << 12;
            m0.start();
            m1.start();
            m2.start();
            this.in = in;
            this.from = from;
            this.given = given;
            at = 0;
            a = 0L;
            b = -1L;
            x = 0L;
            if (in != null) {
                shift(0);
                shift(0);
            }
        }

        void finish() {
            shift((int) (a >>> 32));
            shift((int) a);
        }

        private void shift(int word) {
            if (in != null) {
                x = x << 32 | (at < given ? get(in, from + 4 * at) & 0xFFFFFFFFL : 0L);
            } else {
                if (at == words.length) words = java.util.Arrays.copyOf(words, 2 * at);
                words[at] = word;
            }
            at++;
        }

        /** r: the 65,536th part of the interval. */
        private void narrow(long r, int low, int high) {
            b = a + r * high - 1L;
            a = a + r * low;
            if ((b - a) >>> 32 == 0L) settle();
        }

        private void settle() {
            while (true) {
                if ((a ^ b) >>> 32 != 0L && (b - a) >>> 24 == 0L) {
                    long edge = b >>> 32 << 32;
                    if (b - edge >= edge - a) a = edge; else b = edge - 1L;
                }
                if ((a ^ b) >>> 32 != 0L) return;
                shift((int) (a >>> 32));
                a = a << 32;
                b = b << 32 | 0xFFFFFFFFL;
            }
        }

        /** (x - a) / r, 65,535 at most: nearly so in floating point, then put right, as that is quicker than a division. */
        private int share(long r) {
            long d = x - a;
            long t = (long) ((double) (d >>> 1) / (double) r * 2.0);
            if (t > 65535L) t = 65535L;
            while (Long.compareUnsigned(t * r, d) > 0) t--;
            while (t < 65535L && Long.compareUnsigned((t + 1L) * r, d) <= 0) t++;
            return (int) t;
        }

        private int nibble(int[] table, int row, int value) {
            long r = (b - a) >>> 16;
            if (in != null) {
                int t = share(r);
                value = table[row + 8] <= t ? 8 : 0;
                value += table[row + value + 4] <= t ? 4 : 0;
                value += table[row + value + 2] <= t ? 2 : 0;
                value += table[row + value + 1] <= t ? 1 : 0;
            }
            int low = table[row + value], high = value < 15 ? table[row + value + 1] : 65536;
            for (int k = 0; k < 16; k++) {
                int now = table[row + k];
                table[row + k] = now + ((k * 32 + ((value - k) >> 31 & 65024) - now) >> 4);
            }
            narrow(r, low, high);
            return value;
        }

        private void learn(int slot, int id) {
            if (known[slot] == id) {
                if (sure[slot] < 15) sure[slot]++;
            } else if (sure[slot] > 1) {
                sure[slot] >>= 1;
            } else {
                known[slot] = id;
                sure[slot] = 1;
            }
        }

        private static int part(int left, int chance) {
            return ((Math.max(left - 4, 0) >> 4) * (chance >> 4) >> 8) + 1;
        }

        void run(int[] ids, int n) {
            long last = 0L, before = 0L;
            for (int place = 0; place < n; place++) {
                int i2 = (int) (((last * 40503L + before * 30011L) >> 5) & (SLOTS_2 - 1));
                int i1 = SLOTS_2 + (int) (((last * 40503L) >> 5) & (SLOTS_1 - 1)), i0 = SLOTS_2 + SLOTS_1;
                int g2 = known[i2], g1 = known[i1], g0 = known[i0];
                int e1 = part(65536, m0.chance(sure[i2]));
                int e2 = e1 + part(65536 - e1, m1.chance(sure[i1]));
                int e3 = e2 + part(65536 - e2, m2.chance(sure[i0]));
                long r = (b - a) >>> 16;
                int which, got;
                if (in != null) {
                    long d = x - a + Long.MIN_VALUE;
                    which = d < e1 * r + Long.MIN_VALUE ? 0 : d < e2 * r + Long.MIN_VALUE ? 1 : d < e3 * r + Long.MIN_VALUE ? 2 : 3;
                } else {
                    int id = ids[place];
                    which = id == g2 ? 0 : id == g1 ? 1 : id == g0 ? 2 : 3;
                }
                narrow(r, which == 0 ? 0 : which == 1 ? e1 : which == 2 ? e2 : e3, which == 0 ? e1 : which == 1 ? e2 : which == 2 ? e3 : 65536);
                if (which == 3) {
                    int want = in != null ? 0 : ids[place];
                    int high = nibble(first, 0, want >> 12), next = nibble(second, 16 * high, want >> 8 & 15), low = want & 255;
                    r = (b - a) >>> 16;
                    if (in != null) low = share(r) >> 8;
                    narrow(r, low << 8, (low + 1) << 8);
                    got = high << 12 | next << 8 | low;
                } else {
                    got = which == 0 ? g2 : which == 1 ? g1 : g0;
                }
                m0.learn(which == 0);
                if (which > 0) m1.learn(which == 1);
                if (which > 1) m2.learn(which == 2);
                learn(i2, got);
                learn(i1, got);
                learn(i0, got);
                ids[place] = got;
                before = last;
                last = got;
            }
        }
    }
}
"""
#: Functions of a session: name, class, SQL type of the result.
FUNCTIONS = {
    "siftwise_ids_encode": ("Encode", "binary"),
    "siftwise_ids_decode": ("Decode", "binary"),
    "siftwise_ids_documents": ("Documents", "array<struct<doc_id:bigint,start:bigint,n_tokens:bigint,ids:binary>>"),
}
_CLASSES: dict[str, object] = {}


def _classes(spark: SparkSession) -> object:
    """The driver's loader of the compiled classes; executors get them in a jar, once an application."""
    app = spark.sparkContext.applicationId
    if app not in _CLASSES:
        compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(spark._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader())
        compiler.cook(SOURCE)
        loader, made = compiler.getClassLoader(), compiler.getBytecodes()
        folder = tempfile.mkdtemp(prefix="siftwise-idcoder-")
        spark._jvm.org.apache.spark.util.ShutdownHookManager.registerShutdownDeleteDir(spark._jvm.java.io.File(folder))
        try:
            with zipfile.ZipFile(path := os.path.join(folder, "siftwise-idcoder.jar"), "w") as jar:
                for name in list(made.keySet()):
                    jar.writestr(f"{name.replace('.', '/')}.class", bytes(made.get(name)))
            spark.sparkContext._jsc.addJar(path)
        except BaseException:
            shutil.rmtree(folder, ignore_errors=True)
            raise
        _CLASSES[app] = loader
    return _CLASSES[app]


def register(spark: SparkSession) -> bool:
    """Give the session the functions of FUNCTIONS; False where it has no JVM to reach."""
    try:
        loader = _classes(spark)
        tables = np.concatenate((idcoder.STRETCH, idcoder.SQUASH)).astype("<i4").tobytes()
        for name, (kind, result) in FUNCTIONS.items():
            function = loader.loadClass(f"{PACKAGE}.Blocks${kind}").newInstance()
            function.setTables(tables)
            spark._jsparkSession.udf().register(name, function, spark._jvm.org.apache.spark.sql.types.DataType.fromDDL(result))
    except (AttributeError, Py4JError, PySparkException):
        return False
    return True
